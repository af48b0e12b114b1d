"""The wide demand view (R01-R03): a star described as data."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import logic


@dataclass(frozen=True)
class Role:
    """A foreign key of the fact, the dimension it names, and the columns the view takes from it, prefixed by the role's
    name.  A fact whose key finds no row drops out, unless the role is optional."""
    name: str
    dimension: str
    on: dict[str, str]  # column of the dimension -> column of the fact, or "role.column" of an earlier role
    columns: list[str] = field(default_factory=list)
    optional: bool = False


def join_roles(fact: DataFrame, dimensions: dict[str, DataFrame], roles: list[Role]) -> DataFrame:
    """``fact`` with one struct column for each role.

    All roles of a dimension project the same columns of it (those that any of them takes) and so share one scan and one
    exchange of it; rows of optional roles without a match hold a null struct."""
    wanted: dict[str, dict[str, None]] = {}
    for r in roles:
        wanted.setdefault(r.dimension, {}).update(dict.fromkeys((*r.on, *r.columns)))
    out = fact
    for r in roles:
        d = dimensions[r.dimension].select(F.struct(*wanted[r.dimension]).alias(r.name))
        same = [F.col(f"{r.name}.{k}") == F.col(fk) for k, fk in r.on.items()]
        out = out.join(d, same, "left" if r.optional else "inner")
    return out


def moq_label(quantity, edges: list[int]) -> Column:
    """Bands from ``edges`` (rising) on: below the first, between two, from the last; a missing quantity is below."""
    c = F.col(quantity)
    bands = [(c >= edges[-1], f">= {edges[-1]}")]
    bands += [(c.between(a, b - 1), f"{a} - {b - 1}") for a, b in reversed(list(zip(edges, edges[1:])))]
    return logic.case(bands, f"< {edges[0]}")


def demand_view(fact: DataFrame, dimensions: dict[str, DataFrame], roles: list[Role], derived: dict[str, Column]) -> DataFrame:
    """The fact's columns, every role's columns as ``role_column``, and the derived ones (which read role columns as
    ``role.column``)."""
    j = join_roles(fact, dimensions, roles)
    own = [F.col(f"{r.name}.{c}").alias(f"{r.name}_{c}") for r in roles for c in r.columns]
    return j.select(*fact.columns, *own, *[c.alias(n) for n, c in derived.items()])
