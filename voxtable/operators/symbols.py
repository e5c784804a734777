"""Symbol inventories: discovering units, giving them ids, encoding sequences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxtable.functions.units import encode_ids

PAD, BOS, EOS, SPACE = "_", "^", "$", " "
CAPACITY = 256
#: Default ids of the four special symbols.
SPECIALS = {PAD: 0, BOS: 1, EOS: 2, SPACE: 3}

SymbolMap = dict[str, list[int]]


class CapacityError(ValueError):
    """More symbols than ids."""


def symbol_inventory(df: DataFrame, units: str = "units") -> DataFrame:
    """Distinct units; deduplicated inside each row before any row is made."""
    return df.select(F.explode(F.array_distinct(units)).alias("unit")).filter("unit is not null").distinct()


def known_symbols(df: DataFrame, symbols: SymbolMap) -> DataFrame:
    return df.sparkSession.createDataFrame([(s,) for s in symbols] or [("",)], "unit string").filter(F.lit(bool(symbols)))


def fresh_symbols(df: DataFrame, symbols: SymbolMap, units: str = "units") -> DataFrame:
    """Units that the map doesn't have."""
    return symbol_inventory(df, units).join(F.broadcast(known_symbols(df, symbols)), "unit", "left_anti")  # a map has CAPACITY symbols at most


def collected(units: DataFrame, most: int = CAPACITY) -> list[str]:
    """A column of distinct symbols on the driver, by code point; too many for the id space is an error, so the list is bounded."""
    found = [r[0] for r in units.limit(most + 1).collect()]
    if len(found) > most:
        raise CapacityError(f"over {most} symbols")
    return sorted(found)


def _free_ids(used: set[int], n: int) -> list[int]:
    free = [i for i in range(CAPACITY) if i not in used]
    if len(free) < n:
        raise CapacityError(f"{n} new symbols, {len(free)} free ids")
    return free[:n]


def build_symbol_map(units: list[str], base: SymbolMap | None = None) -> SymbolMap:
    """Specials first; units that the base map has keep its ids if these are free; the others take the lowest free ids in inventory order."""
    base = base or {}
    out = {s: list(base.get(s, [i])) for s, i in SPECIALS.items()}
    used = {i for ids in out.values() for i in ids}
    rest = []
    for u in dict.fromkeys(units):
        if u in out:
            continue
        if u in base and used.isdisjoint(base[u]):
            out[u] = list(base[u])
            used.update(base[u])
        else:
            rest.append(u)
    return out | {u: [i] for u, i in zip(rest, _free_ids(used, len(rest)), strict=True)}


def extend_symbol_map(old: SymbolMap, fresh: list[str]) -> SymbolMap:
    """Old ids stay; fresh symbols, by code point, take the lowest free ids."""
    new = sorted(set(fresh) - set(old))
    used = {i for ids in old.values() for i in ids}
    return {k: list(v) for k, v in old.items()} | {s: [i] for s, i in zip(new, _free_ids(used, len(new)), strict=True)}


def language_tokens(symbols: SymbolMap, languages: list[str]) -> SymbolMap:
    """The map with a token for each language if there are several; ids follow the largest in use."""
    names = sorted({x for x in languages if x})
    if len(names) < 2:
        return dict(symbols)
    first = 1 + max(i for ids in symbols.values() for i in ids)
    if first + len(names) > CAPACITY:
        raise CapacityError("no ids left for language tokens")
    return dict(symbols) | {f"«{x}»": [first + k] for k, x in enumerate(names)}


def graft_table(df: DataFrame, new: SymbolMap, base: SymbolMap, fresh: list[str]) -> DataFrame:
    """symbol, new_id, base_id of fresh symbols that the base map has."""
    rows = [(s, new[s][0], base[s][0]) for s in fresh if s in base]
    return df.sparkSession.createDataFrame(rows, "symbol string, new_id int, base_id int")


def map_column(symbols: SymbolMap) -> Column:
    """The map as a literal map<string, array<int>>; it has CAPACITY symbols at most."""
    return F.create_map(*[x for k, v in symbols.items() for x in (F.lit(k), F.array(*map(F.lit, v)))])


def encoded(df: DataFrame, symbols: SymbolMap, units: str = "units", language: str | None = "language") -> DataFrame:
    """df with ids: the flat id sequence, null where it is empty or unmappable."""
    lang = F.col(language) if language else None
    return df.withColumn("ids", encode_ids(F.col(units), lang, map_column(symbols), BOS, PAD, EOS))


def dropped_count(df: DataFrame) -> DataFrame:
    """Rows of the two splits with and without an id sequence."""
    rows = df.filter(F.col("split").isin("train", "test"))
    return rows.groupBy("split").agg(F.sum(F.col("ids").isNull().cast("long")).alias("dropped"), F.sum(F.col("ids").isNotNull().cast("long")).alias("written"))


def unsayable(df: DataFrame, symbols: list[str], units: str = "units") -> DataFrame:
    """df with bad (sorted distinct units outside the symbols) and the units without them; rows left empty go."""
    known = F.array(*map(F.lit, symbols))
    bad = F.array_sort(F.array_distinct(F.filter(units, lambda u: ~F.array_contains(known, u))))
    kept = F.filter(units, lambda u: F.array_contains(known, u))
    return df.withColumn("bad", bad).withColumn(units, kept).filter(F.size(units) > 0)


def speaker_gate(df: DataFrame, least: int = 2) -> DataFrame:
    """One row: distinct nonempty speakers, and whether they suffice for multi-speaker training."""
    return df.filter(F.coalesce("speaker", F.lit("")) != "").agg(F.count_distinct("speaker").alias("speakers")).withColumn("trainable", F.col("speakers") >= least)


def require_speakers(df: DataFrame, least: int = 2) -> None:
    n = speaker_gate(df, least).first()["speakers"]
    if n < least:
        raise ValueError(f"{n} speakers, at least {least} are needed")
