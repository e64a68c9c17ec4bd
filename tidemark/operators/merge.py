"""Upsert-and-delete of a change batch into a table, as DataFrame operators.

    kept  = target LEFT JOIN source, minus the deleted rows
    added = source rows whose key no target row has
    result = kept UNION ALL added

The target keeps its multiplicity (equal rows are all updated). It is never shuffled when
the caller has checked that the source is small enough to broadcast. Otherwise both sides
are shuffled on the key; each join of whole rows is of a kind (left, anti) whose large left
side the adaptive skew join can split, and takes both sides straight out of a shuffle, as
that needs. What is only counted or looked up is grouped before its shuffle.

Where neither side repeats a key (`unrepeated`), no group can be large: then one full outer
join does the merge, and the whole rows of each side are shuffled once.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.columns import (
    any_null,
    any_null_sql,
    col,
    names,
    orderable,
    quote,
    row_hash_sql,
    zero_sql,
)
from tidemark.functions.docs import DELETE, ENVELOPE_KEY, OP, SEQ

Key = str | tuple[str, str]

# Rows with a NULL key match nothing, yet a shuffle would send them all to one task. They
# are spread over this many values by a hash of the row. The hash, unlike a random number,
# gives the same value when a lost task is run again.
NULL_SPREAD = 1024


def _pairs(keys: Sequence[Key]) -> list[tuple[str, str]]:
    return [(k, k) if isinstance(k, str) else k for k in keys]


def _all(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def _spread_sql(schema: T.StructType, strict: Sequence[str], keys: Sequence[str]) -> str:
    return (
        f"CASE WHEN {any_null_sql(strict)} THEN pmod({row_hash_sql(schema)}, {NULL_SPREAD}L) + 1 "
        f"ELSE {zero_sql(keys)} END"
    )


class _Sides:
    """Target and source with their keys, and the values to write, under names of their own."""

    def __init__(self, target, source, keys, delete_when, mapping, null_safe, seq, order, small):
        self.pairs = _pairs(keys)
        self.null_safe = set(null_safe)
        t_schema, s_schema = target.schema, source.schema
        self.types = {f.name: f.dataType for f in t_schema}
        if mapping is None:
            mapping = {c: c for c in t_schema.names if c in set(s_schema.names)}
        unknown = [c for c in mapping if c not in self.types]
        if unknown:
            raise ValueError(f"mapping names columns the target does not have: {unknown}")
        self.t_keys = [f"__t{i}" for i in range(len(self.pairs))]
        self.s_keys = [f"__s{i}" for i in range(len(self.pairs))]
        # a key that is written as it is goes through the shuffle once
        s_types = {f.name: f.dataType for f in s_schema}
        keyed = {
            t: k
            for (t, s), k in zip(self.pairs, self.s_keys)
            if isinstance(mapping.get(t), str) and mapping[t] == s and s_types.get(s) == self.types[t]
        }
        self.values = {c: keyed.get(c, f"__v{i}") for i, c in enumerate(mapping)}
        strict = [(t, s) for t, s in self.pairs if t not in self.null_safe]
        strict_t, strict_s = [t for t, _ in strict], [s for _, s in strict]
        self.strict = [k for (t, _), k in zip(self.pairs, self.s_keys) if t not in self.null_safe]

        t_named = [f"{quote(t)} AS {k}" for (t, _), k in zip(self.pairs, self.t_keys)]
        t_names, s_names = [t for t, _ in self.pairs], [s for _, s in self.pairs]
        self.t = target.selectExpr(
            *names(t_schema.names),
            *t_named,
            *([f"{quote(seq)} AS __tseq"] if seq else []),
            f"{_spread_sql(t_schema, strict_t, t_names)} AS __tspread",
        )
        # The keys alone: the scan behind it reads no other column. NULL keys match nothing.
        self.t_matchable = target.where(~any_null(strict_t)).selectExpr(*t_named)

        self.order = [f"__o{i}" for i in range(len(order))]
        delete = F.expr(delete_when) if isinstance(delete_when, str) else delete_when
        same = {f.name for f in s_schema if self.types.get(f.name) == f.dataType}
        values = [
            F.expr(f"{quote(e)} AS {self.values[c]}")
            if isinstance(e, str) and e in same and e == c
            else (col(e) if isinstance(e, str) else e).cast(self.types[c]).alias(self.values[c])
            for c, e in mapping.items()
            if c not in keyed
        ]
        self.s = source.select(
            *[col(s).alias(k) for (_, s), k in zip(self.pairs, self.s_keys)],
            *[col(c).alias(o) for c, o in zip(order, self.order)],
            F.coalesce(delete, F.lit(False)).alias("__delete"),
            *([col(seq).alias("__sseq")] if seq else []),
            *values,
            F.expr(f"{_spread_sql(s_schema, strict_s, s_names)} AS __sspread"),
        )
        self.small = small

    def hint(self, df: DataFrame) -> DataFrame:
        return F.broadcast(df) if self.small else df

    def condition(self, spread: bool) -> Column:
        """Keys equal; `spread` adds the join key of shuffled whole rows."""
        parts = [
            f"{tk} <=> {sk}" if t in self.null_safe else f"{tk} = {sk}"
            for (t, _), tk, sk in zip(self.pairs, self.t_keys, self.s_keys)
        ]
        return F.expr(" AND ".join([*parts, *(["__tspread = __sspread"] if spread else [])]))

    def matchable(self) -> DataFrame:
        """Source rows that can match: no NULL in a key that must be equal."""
        return self.s.where(~any_null(self.strict))

    def key_counts(self) -> DataFrame:
        """Rows per source key, counted before the shuffle: narrow, and a hot key costs one
        row per task."""
        return self.matchable().groupBy(*self.s_keys).agg(F.count(F.lit(1)).alias("__rows"))

    def single(self, counts: DataFrame) -> DataFrame:
        """`matchable` rows whose key comes once. Were a repeated key matched, the merge would be
        refused, so its rows need not be joined with the target, however many they are."""
        other = [f"__h{i}" for i in range(len(self.s_keys))]
        listed = counts.where("__rows > 1").selectExpr(*[f"{k} AS {h}" for k, h in zip(self.s_keys, other)])
        same = F.expr(" AND ".join(f"{a} <=> {b}" for a, b in zip(self.s_keys, other)))
        return self.matchable().join(listed, same, "left_anti")

    def matched_keys(self, keys: DataFrame) -> DataFrame:
        """Keys that both sides have, each once."""
        if self.small:
            return self.t_matchable.join(F.broadcast(keys), self.condition(spread=False), "left_semi").distinct()
        return self.t_matchable.distinct().join(keys, self.condition(spread=False), "left_semi")

    def newest_per_key(self) -> DataFrame:
        """One row per source key, the newest by `order`, then by its values. Rows that
        cannot be it are dropped before the shuffle."""
        rest = [c for c in self.s.columns if c not in (*self.s_keys, *self.order, "__sspread")]
        sortable = [c for c in rest if orderable(self.s.schema[c].dataType)]
        window = Window.partitionBy(*self.s_keys).orderBy(*[F.desc(c) for c in (*self.order, *sortable)])
        rows = self.matchable().withColumn("__place", F.row_number().over(window))
        return rows.where("__place = 1").drop("__place")


def merge_parts(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[Key],
    *,
    delete_when: str | Column = f"{OP} = '{DELETE}'",
    mapping: Mapping[str, Column | str] | None = None,
    insert_deletes: bool = True,
    null_safe: Sequence[str] = (),
    seq_guard: str | None = None,
    on_duplicate: str = "error",
    order: Sequence[str] | None = None,
    small_source: bool = False,
    unique: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """The two parts of a merge: target rows kept (or updated), and source rows added.

    keys            column names, or (target name, source name) pairs; all must be equal
    delete_when     a matched row leaves the table where this holds for the source row;
                    it goes before the update
    mapping         target column -> source column or expression; default: the columns both have.
                    A column not mapped keeps its value, and is NULL in added rows
    insert_deletes  a delete that matches nothing is added as a row (True) or ignored
    null_safe       target key columns in which NULL equals NULL
    seq_guard       column: a matched row changes only if the source's value is greater
    on_duplicate    several source rows match one target row: 'error' (raised when the
                    rows are computed), or 'latest' to take the newest of each source key
    order           source columns that tell which row is newest; default the sequence
    small_source    the caller has checked the source's size: broadcast it
    unique          the caller has checked that no source key repeats (`no_repeats`): the target is
                    then read twice, its whole rows and its keys, and not a third time for the check
    """
    if on_duplicate not in ("error", "latest"):
        raise ValueError(f"on_duplicate must be 'error' or 'latest', not {on_duplicate!r}")
    if order is None:
        order = [SEQ] if SEQ in source.columns else []
    sides = _Sides(target, source, keys, delete_when, mapping, null_safe, seq_guard, order, small_source)
    if on_duplicate == "latest":
        one = sides.newest_per_key()
        found = sides.matched_keys(one.select(*sides.s_keys))
        candidates = one.unionByName(sides.s.where(any_null(sides.strict)))
        allowed = F.lit(True)
    elif unique:
        one = candidates = sides.s
        found = sides.matched_keys(sides.matchable().select(*sides.s_keys))
        allowed = F.lit(True)
    else:
        counts = sides.key_counts()
        one = sides.matchable() if small_source else sides.single(counts)
        found = sides.matched_keys(counts.select(*sides.s_keys))
        candidates = sides.s
        # A check of its own: it reads the key columns of the target, and no others.
        repeated = counts.where("__rows > 1").select(*sides.s_keys)
        clashes = sides.matched_keys(repeated).agg(F.count(F.lit(1))).scalar()
        text = "several source rows match one target row: reduce the source, or take the latest on duplicates"
        allowed = F.when(clashes > 0, F.raise_error(F.lit(text)).cast("boolean")).otherwise(True)

    hit = "coalesce(__hit, false)"
    acts = f"({hit} AND coalesce(__sseq > __tseq, false))" if seq_guard else hit
    values = sides.values
    whole_rows = sides.condition(spread=not small_source)
    kept = (
        sides.t.where(allowed)
        .join(sides.hint(one.withColumn("__hit", F.lit(True))), whole_rows, "left")
        .where(f"NOT ({acts} AND coalesce(__delete, false))")
        .selectExpr(
            *[
                f"CASE WHEN {acts} THEN {values[c]} ELSE {quote(c)} END AS {quote(c)}" if c in values else quote(c)
                for c in sides.types
            ]
        )
    )

    if not insert_deletes:
        candidates = candidates.where("NOT __delete")
    if not small_source:
        found = found.withColumn("__tspread", F.expr(zero_sql(sides.t_keys)))
    added = candidates.join(found, whole_rows, "left_anti").select(
        *[
            F.expr(f"{values[c]} AS {quote(c)}") if c in values else F.lit(None).cast(dtype).alias(c)
            for c, dtype in sides.types.items()
        ]
    )
    return kept, added


def no_repeats(source: DataFrame, keys: Sequence[Key], null_safe: Sequence[str] = ()) -> bool:
    """Whether no key of the source repeats, NULL keys aside; in `null_safe` target columns a NULL is a key like others.
    Meant for a staged source, of which it reads the keys."""
    pairs = _pairs(keys)
    strict = [s for t, s in pairs if t not in set(null_safe)]
    counts = source.where(~any_null(strict)).groupBy(*[col(s) for _, s in pairs]).agg(F.count(F.lit(1)).alias("__rows"))
    return counts.where("__rows > 1").isEmpty()


def unrepeated(target: DataFrame, source: DataFrame, keys: Sequence[Key], null_safe: Sequence[str] = ()) -> dict[str, bool]:
    """Which sides of a merge have each key once, as options of it: a job over the keys of each side."""
    unique = no_repeats(source, keys, null_safe)
    return {"unique": unique, "unique_target": unique and no_repeats(target, [t for t, _ in _pairs(keys)], null_safe)}


class MergeCounts:
    """How many rows a merge adds, updates and deletes, and source rows it ignores: observed in the job that writes
    its result, so counting costs no job of its own."""

    NAMES = ("inserted", "updated", "deleted", "ignored")

    def __init__(self) -> None:
        self._seen = Observation()

    def watch(self, rows: DataFrame) -> DataFrame:
        """`rows` say in `__did` what was done. The job that is observed must be one of the frame's own session."""
        return rows.observe(self._seen, *[F.count_if(F.col("__did") == n).alias(n) for n in self.NAMES])

    def get(self) -> dict[str, int]:
        """After the job; target rows that one change meets count each."""
        return {n: self._seen.get[n] for n in self.NAMES}


def merge_colocated(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    partitions: int | None,
    *,
    delete_when: str | Column = f"{OP} = '{DELETE}'",
    insert_deletes: bool = True,
    seq_guard: str | None = None,
    counts: MergeCounts | None = None,
) -> DataFrame:
    """The whole merge as one full outer join, for a target that is stored in `partitions` buckets of the keys.

    Only the source is shuffled, into the target's buckets; each task then holds whole buckets of the result, which can
    be written as they are. No source key may repeat (`no_repeats`), and NULL keys match nothing: source rows that have one are
    added beside the join, so they are never gathered in one task. `counts` are gathered where the rows go by.

    Without `partitions`, both sides are shuffled to as many tasks as the session takes, so none holds a whole bucket.
    """
    sides = _Sides(target, source, keys, delete_when, None, (), seq_guard, (), False)
    if partitions is None:
        rows = _joined(sides, sides.s, True, insert_deletes, seq_guard)
        return _staying(counts.watch(rows) if counts else rows)
    values, unmet = sides.values, _unmet(insert_deletes)
    whole = _joined(sides, sides.matchable().repartition(partitions, *sides.s_keys), False, insert_deletes, seq_guard)
    keyless = sides.s.where(any_null(sides.strict)).select(
        *[F.expr(f"{values[c]} AS {quote(c)}") if c in values else F.lit(None).cast(t).alias(c) for c, t in sides.types.items()],
        F.expr(f"{unmet} AS __did"),
        F.lit(False).alias("__was"),
    )
    rows = whole.union(keyless)
    rows = counts.watch(rows) if counts else rows
    return _staying(rows)


def _unmet(insert_deletes: bool) -> str:
    return "'inserted'" if insert_deletes else "if(__delete, 'ignored', 'inserted')"


def _joined(sides: _Sides, source: DataFrame, spread: bool, insert_deletes: bool, seq_guard: str | None) -> DataFrame:
    """Both sides in a full outer join by the key; `__did` says what becomes of a row, `__was` whether it is the target's."""
    values = sides.values
    old, new = sides.t.withColumn("__old", F.lit(True)), source.withColumn("__hit", F.lit(True))
    matched = "(coalesce(__old, false) AND coalesce(__hit, false))"
    acts = f"({matched} AND coalesce(__sseq > __tseq, false))" if seq_guard else matched
    taken = f"({acts} OR __old IS NULL)"
    met = f"CASE WHEN {acts} THEN if(__delete, 'deleted', 'updated') WHEN {matched} THEN 'ignored' WHEN __old THEN NULL"
    return old.join(new, sides.condition(spread), "full_outer").selectExpr(
        *[f"CASE WHEN {taken} THEN {values[c]} ELSE {quote(c)} END AS {quote(c)}" if c in values else quote(c) for c in sides.types],
        f"{met} ELSE {_unmet(insert_deletes)} END AS __did",
        "coalesce(__old, false) AS __was",
    )


def _staying(rows: DataFrame) -> DataFrame:
    stays = "__did IS NULL OR __did IN ('inserted', 'updated') OR (__did = 'ignored' AND __was)"
    return rows.where(stays).drop("__did", "__was")


def merge(target: DataFrame, source: DataFrame, keys: Sequence[Key], *, unique_target: bool = False, **options) -> DataFrame:
    """`merge_parts`, put together: the whole table after the merge. `unique_target`: the caller has checked that no key of
    the target repeats; where the source is `unique` too (`unrepeated`), both are joined once."""
    rest = {k: v for k, v in options.items() if k not in ("unique", "small_source", "on_duplicate", "order")}
    if unique_target and options.get("unique") and not options.get("small_source") and options.get("on_duplicate", "error") == "error":
        return _merge_once(target, source, keys, **rest)
    kept, added = merge_parts(target, source, keys, **options)
    return kept.unionByName(added)


def _merge_once(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[Key],
    *,
    delete_when: str | Column = f"{OP} = '{DELETE}'",
    mapping: Mapping[str, Column | str] | None = None,
    insert_deletes: bool = True,
    null_safe: Sequence[str] = (),
    seq_guard: str | None = None,
) -> DataFrame:
    """The merge of two sides without repeated keys. Rows with a NULL key match nothing and are spread, as ever."""
    sides = _Sides(target, source, keys, delete_when, mapping, null_safe, seq_guard, (), False)
    return _staying(_joined(sides, sides.s, True, insert_deletes, seq_guard))


def replace_children(
    target: DataFrame,
    source: DataFrame,
    parents: Sequence[Key] = (ENVELOPE_KEY,),
    *,
    delete_when: str | Column = f"{OP} = '{DELETE}'",
    seq_guard: str | None = None,
    small_source: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Merge by whole documents: every target row of a document in the batch goes, and the
    rows of its new version come in its place, so children gone from the array go too, and
    a delete needs no document text. Returns (kept, added) as `merge_parts` does.

    With `seq_guard`, a document whose rows in the target are not older is left as it is.
    """
    pairs = _pairs(parents)
    t_names, s_names = [t for t, _ in pairs], [s for _, s in pairs]
    p_names = [f"__p{i}" for i in range(len(pairs))]
    small = F.broadcast if small_source else (lambda df: df)

    def spread(df: DataFrame, columns: Sequence[str]) -> DataFrame:
        return df.withColumn("__spread", F.expr(_spread_sql(df.schema, columns, columns)))

    def same(columns: Sequence[str]) -> list[Column]:
        equal = [col(c) == F.col(p) for c, p in zip(columns, p_names)]
        return equal if small_source else [*equal, F.col("__spread") == F.col("__pspread")]

    batch = (
        source.where(~any_null(s_names))
        .groupBy(*[col(s).alias(p) for s, p in zip(s_names, p_names)])
        .agg((F.max(col(seq_guard)) if seq_guard else F.lit(True)).alias("__sseq"))
        .withColumn("__pspread", F.expr(zero_sql(p_names)))
    )
    older = [F.col("__sseq") > col(seq_guard)] if seq_guard else []
    rows = target if small_source else spread(target, t_names)
    kept = rows.join(small(batch), _all([*same(t_names), *older]), "left_anti").drop("__spread")

    delete = F.expr(delete_when) if isinstance(delete_when, str) else delete_when
    fresh = source.where(~F.coalesce(delete, F.lit(False)))
    if seq_guard:
        # Newest sequence of each document in the target: grouped first, so a document of
        # very many rows is small before anything is shuffled.
        newest = target.where(~any_null(t_names)).groupBy(*[col(t) for t in t_names])
        newest = newest.agg(F.max(col(seq_guard)).alias("__tseq")).select(
            *[col(t).alias(p) for t, p in zip(t_names, p_names)],
            "__tseq",
            F.expr(zero_sql(t_names)).alias("__pspread"),
        )
        rows = fresh if small_source else spread(fresh, s_names)
        fresh = rows.join(newest, _all([*same(s_names), F.col("__tseq") >= col(seq_guard)]), "left_anti")
    types = {f.name: f.dataType for f in target.schema}
    added = fresh.select(
        *[
            (col(c).cast(types[c]) if c in source.columns else F.lit(None).cast(types[c])).alias(c)
            for c in target.columns
        ]
    )
    return kept, added
