"""Models as of a place in the series: fits on the points before a cut, for a table of cuts at once.

`as_of_series` puts points and requests in one index (see `sequence`): a
request is a mark at its date, and its index is the number of points before
it, the cut. The written table then answers every as-of question:

  - fits (`fit_split_as_of`, `fit_best_as_of`): points and cuts of a series
    stream by together, in chunks of `CHUNK` places. While they do, the sums of
    all samples run along, and at each cut the samples that can still win are
    handed on. Sums of the chunks before are merged in for series that have
    several, so a long series is spread over tasks.
  - recent games (`history.recent_games`): the last places before the cut.

No request meets its history: a cut costs one row of sums.

Series of at most `CHUNK` points and cuts need no index (`fit_best_as_of_short`): their rows move once, by their key, and a
cut's fit is chosen from what the kernel hands on with the cut itself.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as ST

from .fit import (CHUNK, DIGITS, EXACT, P, SUMS, _arrow_partials, _choose, _finish, _kernel_tools, _runs, _sums_schema,
                  from_begin, model_columns, row_hash, run_columns, whole)
from .sequence import with_sequence_index

BLOCK = 1 << 10     # points whose running sums of all samples are in memory at once


@dataclass
class AsOfSeries:
    """A written table of points (with `idx`) and requests (with `before`) of the same series."""
    table: DataFrame
    keys: list[str]

    def points(self) -> DataFrame:
        return self.table.where("_p IS NOT NULL").select(*self.keys, "_p.*", "idx")

    def requests(self, before: str = "before") -> DataFrame:
        return self.table.where("_w IS NOT NULL").select(*self.keys, "_w.*", F.col("idx").alias(before))

    def stream(self, y: str = "pts") -> DataFrame:
        """Points (x, y) and cuts (x, null) in one scan."""
        return self.table.select(*self.keys, F.col("idx").alias("x"), F.col(f"_p.{y}").alias("y"),
                                 F.col("_w").isNotNull().alias("cut"))


def as_of_series(points: DataFrame, wanted: DataFrame, keys: Sequence[str], order: Sequence[str],
                 at: str = "rdate", path: str | None = None, values: Sequence[str] | None = None) -> AsOfSeries:
    """Index `points` by `order` (its first column is a time) and find each wanted row's place: points before its `at`.

    One job writes the table; a wanted row whose key has no points has before = 0. The points keep their columns
    `values` (all).
    """
    keys = list(keys)
    time, *rest = order
    p = points.select(*keys, F.col(time).alias("_t"), F.lit(1).alias("_kind"), F.lit(None).cast("bigint").alias("_tie"),
                      *[F.col(c).alias(f"_r{i}") for i, c in enumerate(rest)],
                      F.struct(*[c for c in points.columns if c not in keys and (values is None or c in values)]).alias("_p"))
    w = wanted.select(*keys, F.col(at).alias("_t"), F.lit(0).alias("_kind"),
                      F.xxhash64(*wanted.columns).alias("_tie"),           # splits the requests of one moment
                      F.struct(*[c for c in wanted.columns if c not in keys]).alias("_w"))
    rows = p.unionByName(w, allowMissingColumns=True).withColumn("_point", F.col("_p").isNotNull())
    indexed = with_sequence_index(rows, keys, ["_t", "_kind", "_tie", *[f"_r{i}" for i in range(len(rest))]],
                                  counted="_point", path=path, keep=["_p", "_w"])
    return AsOfSeries(indexed, keys)


def _sums_kernel(mask_of, reps: int, block: int):
    """`sums_at(h, x, y, at)`: (cuts, reps, 6), the sums of the first `at[i]` points."""
    import numpy as np

    def sums_at(h, x, y, at):
        out = np.zeros((len(at), reps, 6))
        carry = np.zeros((reps, 6))
        for lo in range(0, len(x), block):
            hi = min(lo + block, len(x))
            mask = mask_of(h[lo:hi])
            here = np.flatnonzero((at > lo) & (at <= hi))
            xs, ys = x[lo:hi], y[lo:hi]
            for t, term in enumerate((np.ones_like(xs), xs, ys, xs * xs, xs * ys, ys * ys)):
                running = np.cumsum(mask * term[None, :], axis=1)
                running += carry[:, t, None]
                out[here, :, t] = running[:, at[here] - lo - 1].T
                carry[:, t] = running[:, -1]
        return out
    return sums_at


def _cut_kernel(keys: list[str], rep_ids: Sequence[int], threshold: int, winners: bool, chunk: int, block: int):
    """Kernel over runs of one (keys, _chunk) by place: sums of earlier chunks (_kind 0), points (1) and cuts (2).

    Emits, of every cut (keys, before) and rep, the sums of the chunk's points before it, x counted from the chunk's
    begin; with `winners` only of reps that can still win, counting the chunks before as well.
    """
    import numpy as np
    import pandas as pd

    reps = len(rep_ids)
    mask_of, can_win = _kernel_tools(rep_ids, threshold)
    sums_at = _sums_kernel(mask_of, reps, block)
    names = list(SUMS)

    def one(pdf):
        kind = pdf["_kind"].to_numpy()
        cut = np.flatnonzero(kind == 2)
        if not len(cut):
            return None
        x = pdf["_x"].to_numpy()
        cut = cut[np.append(True, np.diff(x[cut]) > 0)]                           # requests of one place are one cut
        number, begin = int(pdf["_chunk"].iloc[0]), int(pdf["_chunk"].iloc[0]) * chunk
        base = np.zeros((reps, 6))
        earlier = pdf[kind == 0]
        if len(earlier):
            base[earlier["rep"].to_numpy().astype(int)] = earlier[["n", *names]].to_numpy(dtype=float)
        point = kind == 1
        pts = pdf[point]
        local = sums_at(pts["_h"].to_numpy(dtype=np.int64), pts["_x"].to_numpy(dtype=float) - begin,
                        pts["_y"].to_numpy(dtype=float), np.cumsum(point)[cut])
        n, sx, sy, sxx, sxy, syy = (local[..., i] for i in range(6))
        total = base + np.stack([n, sx + begin * n, sy, sxx + 2 * begin * sx + float(begin) ** 2 * n, sxy + begin * sy, syy], -1)
        at, pick = np.nonzero(can_win(total) if winners else total[..., 0] > 0)
        sel = local[at, pick]
        d = {k: pdf[k].take(cut[at]).to_numpy() for k in keys}
        d.update(_chunk=np.full(len(at), number), before=x[cut[at]].astype(np.int64), rep=pick.astype(np.int32),
                 n_all=total[at, 0, 0].astype(np.int64), n=sel[:, 0].astype(np.int64),
                 **{c: sel[:, i + 1] for i, c in enumerate(names)})
        return d

    columns = [*keys, "_chunk", "before", "rep", "n_all", "n", *names]

    def emit(pdf, starts, ends):
        parts = [part for s, e in zip(starts, ends) if (part := one(pdf.iloc[s:e])) is not None]
        return pd.DataFrame({c: np.concatenate([d[c] for d in parts]) for c in columns}) if parts else None
    return _runs(emit)


def _sums_at_cuts(stream: DataFrame, keys: list[str], rep_ids: Sequence[int], frac: float, winners: bool,
                  chunk: int) -> DataFrame:
    """(keys, before, rep, n_all, n, sums) of every cut of `stream` (keys, x, y, cut)."""
    threshold, exact = int(-(-frac * P // 1)), whole(stream, "x", "y")
    null = lambda kind: F.lit(None).cast(kind)
    place = F.when(F.col("cut"), F.col("x") - 1).otherwise(F.col("x"))      # a cut belongs to the chunk of the last point before it
    rows = (stream.where(F.when(F.col("cut"), F.col("x") > 0).otherwise(F.col("x").isNotNull() & F.col("y").isNotNull()))
            .select(*keys, F.floor(place / F.lit(chunk)).cast("bigint").alias("_chunk"), F.col("x").cast("double").alias("_x"),
                    F.when(F.col("cut"), 2).otherwise(1).alias("_kind"), F.col("y").cast("double").alias("_y"),
                    F.when(~F.col("cut"), row_hash(keys, "x")).alias("_h")))
    longest = stream.agg(F.max("x")).first()[0]
    before = None
    if longest is not None and longest > chunk:
        # Series of several chunks: the sums of all chunks before each one.
        points = stream.where(~F.col("cut")).withColumn("_c", F.floor(F.col("x") / chunk).cast("bigint"))
        full = points.where(F.col("x") % chunk == chunk - 1).select(*keys, "_c").distinct()
        part = _arrow_partials(points.join(full, [*keys, "_c"], "left_semi"), [*keys, "_c"], rep_ids, frac, "x", "y",
                               dense=False, chunk=chunk, extra=["_c"], empty=True)
        run = Window.partitionBy(*keys, "rep").orderBy("_c").rowsBetween(Window.unboundedPreceding, 0)
        before = part.select(*keys, (F.col("_c") + 1).alias("_chunk"), "rep", F.sum("n").over(run).alias("n"),
                             *[F.sum(c).over(run).alias(c) for c in SUMS])
        no_sums = [null("int").alias("rep"), null("double").alias("n"), *[null("double").alias(c) for c in SUMS]]
        rows = rows.select("*", *no_sums).unionByName(before.select(
            *keys, "_chunk", null("double").alias("_x"), F.lit(0).alias("_kind"), null("double").alias("_y"), null("bigint").alias("_h"),
            "rep", *[F.col(c).cast("double").alias(c) for c in ("n", *SUMS)]))
    # Within a run: earlier chunks, then by place, points before the cut behind them.
    by_place = F.col("_x") - F.when(F.col("_kind") == 2, F.lit(0.5)).otherwise(F.lit(0.0))
    rows = rows.select("*", *run_columns(keys)).repartition("_g").sortWithinPartitions("_g", "_g2", by_place)
    key_fields = [f for f in rows.schema.fields if f.name in [*keys, "_chunk"]] + [ST.StructField("before", ST.LongType())]
    at = rows.mapInPandas(_cut_kernel(keys, rep_ids, threshold, winners, chunk, BLOCK), _sums_schema(key_fields))
    at = at.select(*keys, "_chunk", "before", "rep", "n_all", "n", *from_begin(chunk, exact))
    if before is not None:
        add = lambda c: (F.col(c) + F.coalesce(F.col(f"{c}_0"), F.lit(0)))
        kind = {"n": "bigint", **dict.fromkeys(SUMS, EXACT if exact else "double")}
        at = (at.join(before.select(*keys, "_chunk", "rep", *[F.col(c).alias(f"{c}_0") for c in kind]), [*keys, "_chunk", "rep"], "left")
              .select(*keys, "before", "rep", "n_all", *[add(c).cast(t).alias(c) for c, t in kind.items()]))
    return at.where("n > 0").drop("_chunk")


CANDIDATE = ("rep", "n", *SUMS)     # what the kernel hands on of a fit


def _short_kernel(columns: list[str], rep_ids: Sequence[int], threshold: int, block: int):
    """Kernel over runs of one series: points and cuts by place. Emits of every cut, with its `columns`, the points before
    it (`n_all`) and the numbers `CANDIDATE` of all reps that can still win, one after the other."""
    import numpy as np
    import pandas as pd

    mask_of, can_win = _kernel_tools(rep_ids, threshold)
    sums_at = _sums_kernel(mask_of, len(rep_ids), block)

    def one(pdf):
        cut = pdf["_cut"].to_numpy(dtype=bool)
        if not cut.any():
            return None
        places, of = np.unique(np.cumsum(~cut)[cut], return_inverse=True)        # requests of one place are one cut
        pts = pdf[~cut]
        total = sums_at(pts["_h"].to_numpy(dtype=np.int64), pts["_x"].to_numpy(dtype=float), pts["_y"].to_numpy(dtype=float), places)
        at, pick = np.nonzero(can_win(total))
        found = np.column_stack([pick.astype(float), total[at, pick]])
        found = np.split(found, np.searchsorted(at, np.arange(1, len(places))))
        rows = pdf.loc[cut, columns].copy()
        rows["n_all"] = total[of, 0, 0].astype(np.int64)
        rows["fits"] = [found[i].ravel() for i in of]
        return rows

    def emit(pdf, starts, ends):
        parts = [part for s, e in zip(starts, ends) if (part := one(pdf.iloc[s:e])) is not None]
        return pd.concat(parts, ignore_index=True) if parts else None
    return _runs(emit)


def fit_best_as_of_short(points: DataFrame, keys: Sequence[str], wanted: DataFrame, order: Sequence[str], at: str = "rdate",
                         reps: int = 100, frac: float = 0.7, y: str = "pts") -> DataFrame:
    """`fit_best_as_of` with the points before the `at` of each wanted row, for series of few points (see `CHUNK`): a series
    is held by a task. `points` are in no order yet, `order` (its first column is a time) puts them in one."""
    keys, exact = list(keys), whole(points, y)
    time, *rest = order
    more = [c for c in wanted.columns if c not in keys and c != at]
    some = lambda df: df.where(" and ".join(f"`{k}` is not null" for k in keys))
    rows = some(points).select(*keys, F.col(time).alias("_t"), F.lit(False).alias("_cut"),
                               *[F.col(c).alias(f"_r{i}") for i, c in enumerate(rest)], F.col(y).cast("double").alias("_y"))
    cuts = some(wanted).select(*keys, F.col(at).alias("_t"), F.lit(True).alias("_cut"), *[F.col(c).alias(f"_w{i}") for i, c in enumerate(more)])
    # at equal times cuts come before points
    by = [F.asc("_t"), F.desc("_cut"), *[F.asc(f"_r{i}") for i in range(len(rest))]]
    series = Window.partitionBy(*keys).orderBy(*by)
    before = F.sum(F.when(F.col("_cut"), 0).otherwise(1)).over(series.rowsBetween(Window.unboundedPreceding, 0))
    rows = (rows.unionByName(cuts, allowMissingColumns=True).repartition(*keys)
            .withColumn("_x", F.when(F.col("_cut"), before).otherwise(before - 1).cast("bigint"))
            .where(F.when(F.col("_cut"), F.col("_x") > 0).otherwise(F.col("_y").isNotNull())))
    columns = [*keys, *[f"_w{i}" for i in range(len(more))]]
    rows = rows.select(*columns, "_cut", F.col("_x").cast("double").alias("_x"), "_y",
                       F.when(~F.col("_cut"), row_hash(keys, "_x")).alias("_h"), F.lit(0).alias("_chunk"))
    rows = rows.select("*", *run_columns(keys))
    schema = ST.StructType([rows.schema[c] for c in columns] + [
        ST.StructField("n_all", ST.LongType()), ST.StructField("fits", ST.ArrayType(ST.DoubleType()))])
    got = rows.mapInPandas(_short_kernel(columns, range(reps), int(-(-frac * P // 1)), BLOCK), schema)

    def fit(i):
        number = lambda c: F.get("fits", i * len(CANDIDATE) + CANDIDATE.index(c))
        kind = lambda c: number(c).cast("bigint") if c == "n" or exact else number(c)
        return F.struct(number("rep").cast("int").alias("rep"), *[kind(c).alias(c) for c in CANDIDATE[1:]])

    def model(s):
        slope, intercept, rmse, r2 = model_columns(exact=exact, of=lambda c: s[c])
        return F.struct(F.round(rmse, DIGITS).alias("k"), s["rep"].alias("rep"), s["n"].alias("n_fit"), slope, intercept, rmse, r2)

    fits = F.transform(F.sequence(F.lit(0), (F.size("fits") / len(CANDIDATE)).cast("int") - 1), fit)
    best = F.array_min(F.transform(F.filter(fits, lambda s: s["n"] > 0), model))
    named = [F.col(f"_w{i}").alias(c) for i, c in enumerate(more)]
    chosen = got.where(F.size("fits") > 0).select(*keys, *named, "n_all", best.alias("b")).where("b is not null")
    return _finish(chosen.select(*keys, *more, "n_all", *[f"b.{c}" for c in ("rep", "n_fit", "slope", "intercept", "rmse", "r2")]), keys, [*more, "rep"])


def _stream_of(points: DataFrame, keys: list[str], wanted: DataFrame, x: str, y: str) -> DataFrame:
    return points.select(*keys, F.col(x).alias("x"), F.col(y).alias("y"), F.lit(False).alias("cut")).unionByName(
        wanted.select(*keys, F.col("before").alias("x"), F.lit(None).cast(points.schema[y].dataType).alias("y"), F.lit(True).alias("cut")))


def _wanted_models(wanted: DataFrame, models: DataFrame, keys: list[str], extra: Sequence[str] = ()) -> DataFrame:
    more = [c for c in wanted.columns if c not in keys and c != "before"]
    return _finish(wanted.join(models, [*keys, "before"]), keys, [*more, *extra])


def fit_split_as_of(points: DataFrame, keys: Sequence[str], wanted: DataFrame, frac: float = 0.7, reg: float = 0.001,
                    rep: int = 0, x: str = "idx", y: str = "pts", chunk: int = CHUNK, stream: DataFrame | None = None) -> DataFrame:
    """M4 as of a place in the series: the fit on the first `before` points of it.

    `points` has the 0..n-1 position x; `wanted` has the keys, `before` and any further columns, which stay; rows
    with before = 0 vanish. `stream`: both in one table (`AsOfSeries.stream`), if there is one.
    """
    keys = list(keys)
    stream = _stream_of(points, keys, wanted, x, y) if stream is None else stream
    at = _sums_at_cuts(stream, keys, [0, rep], frac, False, chunk)
    side = lambda r: F.max(F.when(F.col("rep") == r, F.struct("n", *SUMS)))
    both = at.groupBy(*keys, "before").agg(F.max("n_all").alias("n_all"), side(0).alias("a"), side(1).alias("s"))
    use = F.when(F.col("s.n") > 0, F.col("s")).otherwise(F.col("a")).alias("u")      # an empty sample: the full fit
    s = both.select(*keys, "before", "n_all", use).select(*keys, "before", "n_all", "u.*")
    models = model_columns(reg, whole(stream, "x", "y"))
    return _wanted_models(wanted, s.select(*keys, "before", "n_all", F.col("n").alias("n_fit"), *models), keys)


def fit_best_as_of(points: DataFrame, keys: Sequence[str], wanted: DataFrame, reps: int = 100, frac: float = 0.7,
                   x: str = "idx", y: str = "pts", chunk: int = CHUNK, stream: DataFrame | None = None) -> DataFrame:
    """M3 as of a place in the series: best of the full fit and reps - 1 samples of the first `before` points.

    See `fit_split_as_of`. A point is in a sample by its own hash, so the samples of a cut are those of `fit_best_of`
    on the points before it.
    """
    keys = list(keys)
    stream = _stream_of(points, keys, wanted, x, y) if stream is None else stream
    at = _sums_at_cuts(stream, keys, range(reps), frac, True, chunk)
    models = model_columns(exact=whole(stream, "x", "y"))
    best = _choose(at.select(*keys, "before", "rep", "n", "n_all", *models), [*keys, "before"], F.max("n_all"))
    return _wanted_models(wanted, best, keys, ["rep"])
