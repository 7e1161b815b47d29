"""Circular wind arithmetic (direction is where the wind comes from). Arguments are SQL text."""

from __future__ import annotations


def direction_deg(tens: str) -> str:
    """Tens of degrees to degrees."""
    return f"({tens} * 10D)"


def component_u(speed: str, direction: str) -> str:
    return f"(-{speed} * sin(radians({direction})))"


def component_v(speed: str, direction: str) -> str:
    return f"(-{speed} * cos(radians({direction})))"


def vector_direction(u: str, v: str, calm: float = 1e-6) -> str:
    """Direction of a mean vector; null when the vector nearly vanishes."""
    return f"if(sqrt({u} * {u} + {v} * {v}) > {calm}D, pmod(degrees(atan2(-{u}, -{v})), 360D), null)"
