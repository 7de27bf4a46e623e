"""Column-name normalisation (driver side, names only)."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Sequence

from pyspark.sql import DataFrame

from starmill import fixed


def normal_name(name: str) -> str:
    return re.sub(fixed.NAME_DROP, "", re.sub(fixed.NAME_GAP, "_", name.strip().lower()))


def normal_names(names: Sequence[str]) -> list[str]:
    """Normalised names, kept apart with ``_2``, ``_3`` ... where two would become equal."""
    wanted = [normal_name(n) for n in names]
    taken, seen, out = set(wanted), Counter(), []
    for name in wanted:
        seen[name] += 1
        final = name
        if seen[name] > 1:
            while final in taken:
                final = f"{name}_{seen[name]}"
                seen[name] += final in taken
            taken.add(final)
        out.append(final)
    return out


def name_collisions(names: Sequence[str]) -> dict[str, list[str]]:
    """Original names that normalise to the same name, for the report."""
    groups: dict[str, list[str]] = {}
    for name in names:
        groups.setdefault(normal_name(name), []).append(name)
    return {k: v for k, v in groups.items() if len(v) > 1}


def normalise_columns(df: DataFrame) -> DataFrame:
    names = normal_names(df.columns)
    return df if names == df.columns else df.toDF(*names)
