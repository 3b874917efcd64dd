"""Keys and folds for names, as Column expressions; a difflib lookup where only Python's ratio will do."""

from __future__ import annotations

import difflib

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# German letters spelled out, and folded.
SPELLED = (("ä", "ae"), ("ö", "oe"), ("ü", "ue"), ("ß", "ss"))
FOLDED = (("ä", "a"), ("ö", "o"), ("ü", "u"), ("ß", "ss"), ("é", "e"), ("à", "a"))


def _replaced(x: Column, pairs: tuple) -> Column:
    for a, b in pairs:
        x = F.replace(x, F.lit(a), F.lit(b))
    return x


def ascii_key(x: Column) -> Column:
    """Lower case, letters a-z and digits only."""
    return F.regexp_replace(F.lower(x), "[^a-z0-9]", "")


def slug(x: Column) -> Column:
    """Lower case with German letters spelled out; runs of anything else become one underscore, none at the ends."""
    return F.regexp_replace(F.regexp_replace(_replaced(F.lower(x), SPELLED), "[^a-z0-9]+", "_"), "^_+|_+$", "")


def duplicate_key(x: Column) -> Column:
    """slug without the word trail; uphill and downhill stay, since they tell lines apart."""
    return F.replace(F.replace(slug(x), F.lit("_trail"), F.lit("")), F.lit("trail_"), F.lit(""))


# Numbered sections, the jump section, a leading three-digit number, then all but letters and digits go.
RESORT_DROPPED = (r"\b(sektion|section)\s*\d+\b", r"\bjump\s*section\b", r"^\d{3}\s*", "[^a-z0-9]")


def resort_key(x: Column, dropped: tuple[str, ...] = RESORT_DROPPED) -> Column:
    """Folded letters; section numbers and a leading three-digit number go, or what `dropped` names."""
    x = _replaced(F.lower(x), FOLDED)
    for pattern in dropped:
        x = F.regexp_replace(x, pattern, "")
    return x


def prefixed_id(prefix: str, x: Column) -> Column:
    return F.concat(F.lit(prefix + "_"), F.regexp_replace(F.regexp_replace(F.lower(x), "[^a-z0-9]+", "_"), "^_+|_+$", ""))


def folded(x: Column) -> Column:
    """For searches: lower case without accents (Latin letters)."""
    return F.translate(F.lower(x), "àáâãäåçèéêëìíîïñòóôõöùúûüýÿ", "aaaaaaceeeeiiiinooooouuuuyy")


def natural_key(x: Column) -> Column:
    """Sorts numbers by value: digits are padded to six places."""
    padded = F.regexp_replace(folded(x), r"(\d+)", "00000$1")
    return F.regexp_replace(padded, r"0*(\d{6})(?!\d)", "$1")


def fuzzy_lookup(left: DataFrame, right: DataFrame, name: str, key_name: str, cutoff: float = 0.8) -> DataFrame:
    """Each distinct `name` of left with the `key_name` of right that fits: equal keys first, else the best difflib ratio
    from the cutoff on, ties to the smaller name.

    right is a name list (sent to the workers; at most 100,000 names), left may be of any size.
    """
    names = [r[0] for r in right.select(key_name).distinct().limit(100_001).collect() if r[0] is not None]
    if len(names) > 100_000:
        raise ValueError("fuzzy_lookup: more than 100,000 names to look up in")
    by_key: dict[str, str] = {}
    for n in sorted(names):
        by_key.setdefault("".join(c for c in n.lower() if c.isascii() and c.isalnum()), n)

    @F.pandas_udf("string")
    def look(keys: pd.Series) -> pd.Series:
        out = []
        for k in keys:
            best = difflib.get_close_matches(k, sorted(by_key), 1, cutoff) if k is not None and k not in by_key else [k]
            out.append(by_key.get(best[0]) if best else None)
        return pd.Series(out, dtype=object)

    keyed = left.select(name).where(F.col(name).isNotNull()).distinct().withColumn("_key", ascii_key(F.col(name)))
    return keyed.withColumn("found", look("_key")).drop("_key")
