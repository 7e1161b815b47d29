"""The corpus queries that SQL can express, for DuckDB over the same tables."""

from __future__ import annotations

from airshed.llm import url_filter
from airshed.llm.decontaminate import WINDOW

# Words of a text, A-Z lower-cased.
_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"[x for x in regexp_split_to_array({_LOWERED}, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+') if x <> '']"


def decontamination() -> str:
    """A window is a list of words; a word is hit if it lies in an occurrence of one."""
    return f"""
    with item as (select coalesce(cast(item_id as varchar), 'null') as item_id, {_WORDS} as w from benchmark),
    cut as (select item_id, w, least({WINDOW}, len(w)) as n from item where len(w) > 0),
    win as (select distinct item_id, n, array_to_string(w[i : i + n - 1], ' ') as phrase
            from (select *, unnest(range(1, len(w) - n + 2)) as i from cut)),
    doc as (select row_number() over () as r, doc_id, {_WORDS} as w from documents),
    sizes as (select distinct n from win),
    place as (select r, i, n, array_to_string(w[i : i + n - 1], ' ') as phrase
              from (select r, w, n, unnest(range(1, len(w) - n + 2)) as i from doc, sizes where len(w) >= n)),
    hit as (select distinct r, i, n, item_id from place join win using (n, phrase)),
    words as (select r, count(distinct spot) as n_hit from (select r, unnest(range(i, i + n)) as spot from hit) group by r),
    items as (select r, count(distinct item_id) as n_items, string_agg(distinct item_id, ',' order by item_id) as ids from hit group by r)
    select doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
      sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
    from doc left join words using (r) left join items using (r)"""


def _host(url: str) -> str:
    host = rf"regexp_extract(coalesce({url}, ''), '^.*?://([^/?#]*)', 1, 's')"
    return f"translate({host}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _fits(on: str, start: str) -> str:
    return f"(host = '{on}' or ends_with(host, '.{on}')) and starts_with(path, '{start}')"


def urls(steps: int = url_filter.STEPS, damping: float = url_filter.DAMPING, threshold: float = url_filter.THRESHOLD) -> str:
    """Rules by length, then the walks along and against links step by step."""
    longest = sorted(url_filter.RULES, key=lambda r: -len(r[0] + r[1]))
    rule = " ".join(f"when {_fits(on, start)} then '{on}{start}'" for on, start, _ in longest)
    said = " ".join(f"when rule = '{on}{start}' then '{verdict}'" for on, start, verdict in longest)
    walk = "\nunion all\n".join(f"select * from f{k}" for k in range(steps + 1))
    step = "".join(
        f"""f{k} as (select f.kind, g.dst as host, sum(f.score * g.weight * {damping}) as score
            from f{k - 1} f join graph g on g.kind = f.kind and g.src = f.host group by 1, 2),
    """
        for k in range(1, steps + 1)
    )
    return f"""
    with page as (select page_id, url, html, {_host('url')} as host,
        regexp_extract(coalesce(url, ''), '^.*?://[^/?#]*([^?#]*)', 1, 's') as path from pages),
    ruled as (select *, case {rule} end as rule from page),
    judged as (select *, case {said} end as said from ruled),
    known as (select host, count(*) filter (where said = 'allow') as a, count(*) filter (where said = 'block') as b, count(*) as n
        from judged where host <> '' group by host),
    seeds as (select 'trust' as kind, host from known where a > 0 and b = 0 union all select 'distrust', host from known where b = n),
    link as (select host as src, {_host('target')} as dst from (select host,
        unnest(regexp_extract_all(coalesce(html, ''), '{url_filter.LINK.replace("(?i)", "").replace("'", "''")}', 1, 'i')) as target from page)),
    pair as (select src, dst, count(*) as c from link where src <> dst and src <> '' and dst <> '' group by 1, 2),
    edge as (select src, dst, c / sum(c) over (partition by src) as weight from pair),
    graph as (select 'trust' as kind, src, dst, weight from edge
        union all select 'distrust', dst, src, weight / sum(weight) over (partition by dst) from edge),
    f0 as (select kind, host, {1 - damping} / count(*) over (partition by kind) as score from seeds),
    {step}every as ({walk}),
    score as (select host, coalesce(sum(score) filter (where kind = 'trust'), 0) as trust,
        coalesce(sum(score) filter (where kind = 'distrust'), 0) as distrust from every group by host)
    select page_id, host, path, rule, coalesce(said, case when coalesce(distrust, 0) > {threshold} * (coalesce(trust, 0) + coalesce(distrust, 0))
        then 'block' else 'allow' end) as verdict
    from judged left join score using (host)"""


# Entries of the CRC-32 table, from its polynomial.
_CRC_TABLE = """crc as (select list(v order by i) as crc_of from (select i, list_reduce(list_prepend(i, range(8)),
        lambda c, k: case when c % 2 = 1 then xor(c // 2, 3988292384) else c // 2 end) as v from range(256) s(i)))"""


def _crc(text: str) -> str:
    """Unsigned CRC-32 of a text's bytes; ``crc`` must be among the tables."""
    pairs = f"list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda x: cast('0x' || x as bigint))"
    return f"xor(list_reduce(list_prepend(4294967295, {pairs}), lambda c, x: xor(c // 256, crc_of[xor(c % 256, x) + 1])), 4294967295)"


def sharding(shards: int = 16) -> str:
    """The middle byte's place in the running sum of sizes gives the shard."""
    return f"""
    with {_CRC_TABLE},
    doc as (select doc_id, cast(strlen(coalesce(text, '')) + 1 as bigint) as size, {_crc("coalesce(text, '')")} as text_crc32
        from documents, crc),
    run as (select *, sum(size) over w as upto, sum(size) over () as total, row_number() over w as place from doc
        window w as (order by doc_id nulls first, size, text_crc32 rows unbounded preceding)),
    cut as (select *, cast(least({shards - 1}, (2 * upto - size) * {shards} // (2 * total)) as integer) as shard from run)
    select doc_id, size, cast(text_crc32 as bigint) as text_crc32, 'bytes' as law, shard,
      cast(place - min(place) over (partition by shard) as bigint) as slot, cast(null as integer) as grown_shard from cut"""


def manifest(fanout: int = 8) -> str:
    """Levels by recursion, siblings by aggregates over a parent's children, folding by recursion again."""
    field = "coalesce(strlen(cast({0} as varchar)) || ':' || cast({0} as varchar), '-')"
    head = " || ".join(field.format(c) for c in ("doc_id", "source", "lang", "n_chars"))
    lowered = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

    def grown(name: str, start: str) -> str:
        return f"""{name} as ({start} union all
        select level + 1, tree, spot // {fanout}, (width + {fanout - 1}) // {fanout}, sha256(string_agg(digest, '' order by spot))
        from {name} where width > 1 group by level, tree, spot // {fanout}, width)"""

    def beside(name: str) -> str:
        return f"""{name}_beside as (select a.level, a.tree, a.spot, coalesce(string_agg(b.digest, '' order by b.spot) filter (b.spot < a.spot), '') as l,
        coalesce(string_agg(b.digest, '' order by b.spot) filter (b.spot > a.spot), '') as r
        from {name} a join {name} b on a.level = b.level and a.tree = b.tree and a.spot // {fanout} = b.spot // {fanout}
        where a.width > 1 group by a.level, a.tree, a.spot)"""

    def folded(name: str, nodes: str, start: str) -> str:
        return f"""{name} as ({start} union all
        select w.row, w.level + 1, w.tree, w.spot // {fanout}, sha256(s.l || w.acc || s.r), w.proof || s.l || s.r
        from {name} w join {nodes}_beside s using (level, tree, spot))"""

    lowest = "select row, 0 as level, tree, spot, coalesce(forged, digest) as acc, '' as proof from base"
    upper = """select walk.row, 0 as level, '' as tree, sub.spot, walk.acc, walk.proof from walk join sub on sub.lang = walk.tree
            where (walk.tree, walk.level) in (select (tree, level) from node where width = 1)"""
    return f"""
    with recursive {_CRC_TABLE},
    leaf as (select row_number() over () as row, doc_id, coalesce('=' || lang, '') as tree,
        sha256({head} || {field.format("text")}) as digest,
        case when {_crc("cast(doc_id as varchar)")} % 3 = 0 then sha256({head} || {field.format(lowered)}) end as forged from documents, crc),
    base as (select *, row_number() over (partition by tree order by doc_id nulls first, digest) - 1 as spot,
        count(*) over (partition by tree) as width from leaf),
    {grown("node", "select 0 as level, tree, spot, width, digest from base")},
    sub as (select tree as lang, digest, row_number() over (order by tree) - 1 as spot, count(*) over () as width from node where width = 1),
    {grown("upper", "select 0 as level, '' as tree, spot, width, digest from sub")},
    {beside("node")},
    {beside("upper")},
    {folded("walk", "node", lowest)},
    {folded("climb", "upper", upper)},
    top as (select level, digest as root from upper where width = 1)
    select doc_id, base.digest as leaf, sub.digest as subroot, root, sha256(proof) as proof_sha256, acc as folded_root, acc = root as verified
    from climb join top using (level) join base using (row) join sub on sub.lang = base.tree"""


def prefix_trie(stride: int = 100, heads: int = 6) -> str:
    """A node is the text of its turns' digests; a node's ancestors are those of its smallest member."""
    role, text = "coalesce(role, '')", "coalesce(text, '')"
    return f"""
    with {_CRC_TABLE},
    turns as (select conv_id as conv, turn, length({text}) as tokens, sha256(strlen({role}) || ':' || {role} || {text}) as t
        from conversations where conv_id is not null),
    placed as (select *, row_number() over (partition by conv order by turn nulls first, t) as place from turns),
    conv as (select conv, count(*) as own, any_value({_crc("cast(conv as varchar)")}) % {heads} as h from placed, crc group by conv),
    begun as (select c.conv, p.place as depth, p.t, p.tokens from conv c join placed p on p.conv = c.conv - c.conv % {stride} and p.place <= c.h),
    taken as (select c.conv, c.own, c.h, count(b.conv) as taken from conv c left join begun b using (conv) group by all),
    rest as (select conv, place - h + taken as depth, t, tokens from placed join taken using (conv) where place > h),
    path as (select *, string_agg(t, '') over (partition by conv order by depth) as node from (select * from begun union all select * from rest)
        union all select conv, 0, '', 0, '' from conv),
    node as (select depth, node, min(conv) as conv, count(*) as n_convs, any_value(tokens) as tokens from path group by depth, node),
    kids as (select left(node, length(node) - 64) as node, count(*) as kids from node where depth > 0 group by 1),
    every as (select n.*, coalesce(kids, 0) as kids from node n left join kids k on k.node = n.node),
    below as (select p.depth, p.node, cast(count(*) filter (e.kids = 0) as bigint) as leaves,
        cast(sum((e.n_convs - 1) * e.tokens) as bigint) as saved from every e join path p on p.conv = e.conv and p.depth <= e.depth group by 1, 2),
    last as (select depth, node, string_agg(cast(conv as varchar), ',' order by conv) as ids
        from path join (select conv, max(depth) as depth from path group by conv) using (conv, depth) group by 1, 2)
    select e.conv as conv_id, e.depth, p.conv as parent_conv_id, e.n_convs, e.kids as n_children, b.leaves as n_leaves, b.saved as saved_tokens,
      sha256(coalesce(ids, '')) as ends_sha256
    from every e join below b using (depth, node) left join last using (depth, node)
    left join node p on p.depth = e.depth - 1 and p.node = left(e.node, length(e.node) - 64)"""


def statements() -> dict[str, str]:
    return {
        "op2_urls": urls(),
        "op5_decontamination": decontamination(),
        "op11_manifest": manifest(),
        "op12_sharding": sharding(),
        "op13_prefix_trie": prefix_trie(),
    }
