"""Loads that enforce declared constraints (V1-V4 at the load): rows split into accepted and quarantined.

A :class:`Contract` says what the serving database would refuse: missing values, texts longer than their
column, numbers outside their type, keys that occur twice, references without a parent. :func:`judge` adds the list of broken rules
to every row in one pass over the input; nothing is dropped. Rows that break no other rule compete for a key: the first in a stated
order is accepted, the others are quarantined as duplicates, so a rejected row never shadows a good one. As in SQL, a key or a
reference that holds a null is never a duplicate or an orphan.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

REASONS = "_motifs"
SALTS = 64  # tasks that a hot key's rows are first compared in

RANGES = {"smallint": (-(2**15), 2**15 - 1), "integer": (-(2**31), 2**31 - 1)}


@dataclass(frozen=True)
class Contract:
    """Constraints of one table. ``texts``: column -> longest value; ``numbers``: column -> ``smallint`` or ``integer``; ``unique``:
    keys, each a tuple of columns; ``references``: column -> name of the parent (its one column holds the keys); ``order``: columns that decide which
    row of a key comes first, then all others."""

    table: str
    not_null: tuple[str, ...] = ()
    texts: dict[str, int] = field(default_factory=dict)
    numbers: dict[str, str] = field(default_factory=dict)
    unique: tuple[tuple[str, ...], ...] = ()
    references: dict[str, str] = field(default_factory=dict)
    order: tuple[str, ...] = ()


# What the serving database declares.
CONTRACTS = {
    "gold_indice_journalier": Contract(
        "gold_indice_journalier", texts={"code_site": 20, "nom_site": 200, "qualificatif": 40, "polluant_resp": 10},
        numbers={"indice_atmo": "smallint"}, unique=(("code_site", "jour"),)),
    "gold_moyennes_journalieres": Contract(
        "gold_moyennes_journalieres", texts={"code_site": 20, "nom_site": 200, "code_polluant": 10, "unite": 20},
        numbers={"nb_mesures": "integer"}, unique=(("code_site", "code_polluant", "jour"),)),
    "gold_depassements": Contract(
        "gold_depassements", texts={"code_site": 20, "nom_site": 200, "code_polluant": 10, "unite": 20, "depassement": 10}),
    "station": Contract(
        "station", not_null=("code_station", "nom"), texts={"code_station": 20, "nom": 200, "code_region": 3, "type_station": 40, "type_influence": 40},
        unique=(("code_station",),), references={"code_region": "region"}),
    "mesure_horaire": Contract(
        "mesure_horaire", not_null=("horodatage",), texts={"code_station": 20, "code_polluant": 10, "depassement": 10},
        unique=(("code_station", "code_polluant", "horodatage"),), references={"code_station": "station", "code_polluant": "polluant"},
        order=("_ingested_at",)),
}


class QuarantineExceeded(RuntimeError):
    """More rows were refused than the load allows; nothing was published."""


def _quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def _row_rules(contract: Contract) -> list[tuple[Column, str]]:
    """Broken-condition and reason of each rule that looks at one row."""
    rules = [(_quoted(c).isNull(), f"manquant:{c}") for c in contract.not_null]
    rules += [(F.char_length(_quoted(c)) > n, f"trop_long:{c}") for c, n in contract.texts.items()]
    rules += [(~_quoted(c).between(*RANGES[kind]), f"hors_bornes:{c}") for c, kind in contract.numbers.items()]
    return rules


def _with_duplicates(df: DataFrame, key: tuple[str, ...], order: list[Column], reason: str) -> DataFrame:
    """Adds ``reason`` to rows without reasons whose key another such row holds first.

    The order is total up to equal rows. Rows of a key are first compared in ``SALTS`` groups, and only the first of each group
    goes on as a candidate, so no task meets all rows of a hot key."""
    competes = F.size(REASONS) == 0
    for c in key:
        competes = competes & _quoted(c).isNotNull()
    keys = [_quoted(c) for c in key]
    # a row's partition is the same when its task is run again, so a lost executor moves no row to another group
    salted = df.withColumn("_competes", competes).withColumn("_salt", F.pmod(F.spark_partition_id(), F.lit(SALTS)))
    first_here = F.row_number().over(Window.partitionBy("_competes", *keys, "_salt").orderBy(*order)) == 1
    local = salted.withColumn("_first", F.col("_competes") & first_here)
    group = F.when(F.col("_first"), F.lit(-1)).otherwise(F.col("_salt"))  # the others stay where they are
    local = local.withColumn("_group", group)
    wins = F.row_number().over(Window.partitionBy("_competes", *keys, "_group").orderBy(*order)) == 1
    loses = F.col("_competes") & ~(F.col("_first") & F.col("_wins"))
    judged = local.withColumn("_wins", wins)
    reasons = F.when(loses, F.array(F.lit(reason))).otherwise(F.col(REASONS))
    return judged.withColumn(REASONS, reasons).drop("_competes", "_salt", "_first", "_group", "_wins")


def judge(df: DataFrame, contract: Contract, parents: dict[str, DataFrame] | None = None) -> DataFrame:
    """All rows of ``df`` with ``_motifs``, the reasons they are refused for (empty: accepted), in the order of the rules.

    Columns that the contract names must exist. ``parents``: for each parent a frame whose first column holds its keys. An empty
    table gives an empty one."""
    columns = df.columns
    broken = [F.when(condition, F.lit(reason)) for condition, reason in _row_rules(contract)]
    for i, (column, parent) in enumerate(contract.references.items()):
        keys = (parents or {})[parent]
        known = keys.select(F.col(keys.columns[0]).alias(f"_pk{i}")).where(F.col(f"_pk{i}").isNotNull()).distinct().withColumn(f"_known{i}", F.lit(True))
        df = df.join(known, _quoted(column) == F.col(f"_pk{i}"), "left")
        broken.append(F.when(_quoted(column).isNotNull() & F.col(f"_known{i}").isNull(), F.lit(f"sans_parent:{column}")))
    out = df.withColumn(REASONS, F.array_compact(F.array(*broken)) if broken else F.array().cast("array<string>"))
    out = out.select(*[_quoted(c) for c in columns], REASONS)
    kinds = dict(out.dtypes)
    rest = [c for c in columns if c not in contract.order and not kinds[c].startswith("map")]
    order = [_quoted(c).asc_nulls_last() for c in (*contract.order, *rest)]
    for key in contract.unique:
        out = _with_duplicates(out, key, order, "doublon:" + ",".join(key))
    return out


def accepted(judged: DataFrame) -> DataFrame:
    return judged.where(F.size(REASONS) == 0).drop(REASONS)


def quarantined(judged: DataFrame) -> DataFrame:
    return judged.where(F.size(REASONS) > 0)


def observed(judged: DataFrame, observation: Observation) -> DataFrame:
    """Counts rows and refused rows while ``judged`` is written."""
    return judged.observe(observation, F.count(F.lit(1)).alias("lues"), F.count_if(F.size(REASONS) > 0).alias("refusees"))


def check_share(metrics: dict, most_refused: float, table: str) -> None:
    """Raises :class:`QuarantineExceeded` when more than the share ``most_refused`` of the rows was refused."""
    if metrics["refusees"] > most_refused * metrics["lues"]:
        raise QuarantineExceeded(f"{table}: {metrics['refusees']} of {metrics['lues']} rows refused, {most_refused:.2%} allowed")
