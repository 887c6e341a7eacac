"""Linear trend per series, as built-in aggregates.

Every fit is one least-squares line `pts ~ idx` per key. Nothing is collected:
a series contributes six sums (n, Sx, Sy, Sxx, Sxy, Syy) through a partial +
final aggregation, so a series of any length costs one hash-aggregate row per
task. Points without x or y (a null: the player did not play) take no part in
any sum. Whole x and y are summed as DECIMAL(38, 0), so the sums, and the D..
below, are exact for series of up to some 5 * 10^9 points, and results do not
depend on the order of summation. Fractional y are summed as doubles.

Closed forms (n points, D.. = n*S.. - S.*S.):
  slope     = Dxy / Dxx                           (0 when x or y has no spread)
  ridge     = slope / (1 + reg / sd_pop(y))       (L2 with standardised x and y)
  intercept = (Sy - slope*Sx) / n
  sse       = (Dyy - 2*slope*Dxy + slope^2*Dxx) / n
  rmse      = sqrt(sse / n);   r2 = 1 - n*sse/Dyy (NULL when y is constant)
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as ST

# Sampling constants: a row is in sample `rep` when
#   (h * A(rep) + B(rep)) mod P < T
# where h is a 31-bit hash of (series key, idx). rep 0 uses A=1, B=0.
P = 2147483647          # 2^31 - 1
T = 1503238553          # ceil(0.7 * P): 70 % of the rows
A_MUL = 2654435761
B_MUL = 1597334677
DIGITS = 6


def row_hash(keys: Sequence[str], x: str = "idx") -> Column:
    """31-bit hash of the series key and position, the same text in SQL engines."""
    text = F.concat_ws("|", *[F.col(k).cast("string") for k in keys], F.col(x).cast("string"))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint") % P


def in_sample(h: Column, rep: Column, frac: float = 0.7) -> Column:
    """Bernoulli(frac) membership of a row with hash `h` in sample `rep`."""
    threshold = int(-(-frac * P // 1))
    a = F.lit(1) + (rep.cast("bigint") * A_MUL) % (P - 1)
    b = (rep.cast("bigint") * B_MUL) % P
    return ((h * a + b) % P) < threshold


WHOLE = (ST.ByteType, ST.ShortType, ST.IntegerType, ST.LongType)
EXACT = "decimal(38,0)"


def whole(df: DataFrame, *columns: str) -> bool:
    """Whether the columns hold whole numbers, whose sums are kept exact."""
    return all(isinstance(df.schema[c].dataType, WHOLE) for c in columns)


def _xy(x: str, y: str, exact: bool) -> tuple[Column, Column]:
    """x and y as numbers to multiply and sum, both null where either is."""
    both, kind = F.col(x).isNotNull() & F.col(y).isNotNull(), "decimal(19,0)" if exact else "double"
    return F.when(both, F.col(x).cast(kind)), F.when(both, F.col(y).cast(kind))


def sums(x: str = "idx", y: str = "pts", exact: bool = False) -> list[Column]:
    xd, yd = _xy(x, y, exact)
    return [F.count(yd).alias("n"), F.sum(xd).alias("sx"), F.sum(yd).alias("sy"),
            F.sum(xd * xd).alias("sxx"), F.sum(xd * yd).alias("sxy"), F.sum(yd * yd).alias("syy")]


def model_columns(reg: float = 0.0, exact: bool = False, of: Callable[[str], Column] = F.col) -> list[Column]:
    """slope, intercept, rmse, r2 from the sums columns (n, sx, sy, sxx, sxy, syy); `exact`: the sums are decimals; `of`
    gives a column by its name."""
    n = F.nullif(of("n"), F.lit(0)).cast("double")      # a series may have no points at all
    col = (lambda c: of(c).cast(EXACT)) if exact else of
    m = F.nullif(of("n"), F.lit(0)).cast(EXACT) if exact else n
    dxx, dxy, dyy = ((m * col(ab) - col(a) * col(b)).cast("double")
                     for ab, a, b in (("sxx", "sx", "sx"), ("sxy", "sx", "sy"), ("syy", "sy", "sy")))
    ols = F.when((dxx > 0) & (dyy > 0), dxy / dxx).otherwise(F.lit(0.0))
    if reg:
        slope = F.when((dxx > 0) & (dyy > 0),
                       ols / (F.lit(1.0) + F.lit(float(reg)) / (F.sqrt(dyy) / n))).otherwise(F.lit(0.0))
    else:
        slope = ols
    sse = F.greatest((dyy - F.lit(2.0) * slope * dxy + slope * slope * dxx) / n, F.lit(0.0))
    return [
        slope.alias("slope"),
        ((of("sy").cast("double") - slope * of("sx").cast("double")) / n).alias("intercept"),
        F.sqrt(sse / n).alias("rmse"),
        F.when(dyy > 0, F.lit(1.0) - n * sse / dyy).alias("r2"),
    ]


def _finish(df: DataFrame, keys: Sequence[str], extra: Sequence[str] = (),
            digits: int | None = DIGITS) -> DataFrame:
    """Round outputs and add the forecast for the next game (x = number of points)."""
    rnd = (lambda c: F.round(c, digits)) if digits is not None else (lambda c: c)
    r = lambda c: rnd(F.col(c)).alias(c)
    pred = F.col("intercept") + F.col("slope") * F.col("n_all").cast("double")
    return df.select(*keys, *extra, F.col("n_all").alias("n"), F.col("n_fit"),
                     r("slope"), r("intercept"), r("rmse"), r("r2"),
                     rnd(pred).alias("prediction"))


def fit_full(points: DataFrame, keys: Sequence[str], x: str = "idx", y: str = "pts",
             reg: float = 0.0, digits: int | None = DIGITS) -> DataFrame:
    """M2 (and G4 with reg > 0): one fit per key on all of its points."""
    keys = list(keys)
    exact = whole(points, x, y)
    s = points.groupBy(*keys).agg(*sums(x, y, exact))
    m = s.select(*keys, F.col("n").alias("n_all"), F.col("n").alias("n_fit"), *model_columns(reg, exact))
    return _finish(m, keys, digits=digits)


def split(points: DataFrame, keys: Sequence[str], frac: float = 0.7, rep: int = 0,
          x: str = "idx") -> DataFrame:
    """M1: the `frac` sample `rep` of every series (deterministic, per row)."""
    return points.where(in_sample(row_hash(keys, x), F.lit(rep), frac))


def fit_split(points: DataFrame, keys: Sequence[str], frac: float = 0.7, reg: float = 0.001,
              rep: int = 0, x: str = "idx", y: str = "pts") -> DataFrame:
    """M4: fit with L2 penalty `reg` on one `frac` sample; forecast from all points.

    A series whose sample is empty falls back to its full fit.
    """
    keys = list(keys)
    flag = in_sample(row_hash(keys, x), F.lit(rep), frac)
    exact = whole(points, x, y)
    xd, yd = _xy(x, y, exact)
    inn = lambda c: F.when(flag, c)
    s = points.groupBy(*keys).agg(
        F.count(yd).alias("n_all"),
        F.count(inn(yd)).alias("n_s"),
        F.sum(xd).alias("sx_a"), F.sum(yd).alias("sy_a"), F.sum(xd * xd).alias("sxx_a"),
        F.sum(xd * yd).alias("sxy_a"), F.sum(yd * yd).alias("syy_a"),
        F.sum(inn(xd)).alias("sx_s"), F.sum(inn(yd)).alias("sy_s"), F.sum(inn(xd * xd)).alias("sxx_s"),
        F.sum(inn(xd * yd)).alias("sxy_s"), F.sum(inn(yd * yd)).alias("syy_s"))
    use = F.col("n_s") > 0
    pick = lambda c: F.when(use, F.col(f"{c}_s")).otherwise(F.col(f"{c}_a")).alias(c)
    s = s.select(*keys, "n_all", F.when(use, F.col("n_s")).otherwise(F.col("n_all")).alias("n"),
                 *[pick(c) for c in ("sx", "sy", "sxx", "sxy", "syy")])
    m = s.select(*keys, "n_all", F.col("n").alias("n_fit"), *model_columns(reg, exact))
    return _finish(m, keys)


CHUNK = 1 << 14   # points per (series, chunk) group handed to one pre-aggregation run


def _kernel_tools(rep_ids: Sequence[int], threshold: int):
    """(mask_of, can_win) over the columns of `rep_ids`; column 0 is the whole series.

    Closures, so that Python workers receive them by value and need not import
    this package. The mask uses exact integer arithmetic modulo the Mersenne
    prime P (x mod P = (x & P) + (x >> 31), folded).
    """
    import numpy as np

    reps = len(rep_ids)
    r = np.array(rep_ids, dtype=np.int64)
    a = (1 + (r * A_MUL) % (P - 1))[:, None]
    b = ((r * B_MUL) % P)[:, None]
    p, digits = P, DIGITS
    bufs: dict = {}

    def buf(name, rows, dtype):
        arr = bufs.get(name)
        if arr is None or arr.shape[1] < rows:
            arr = bufs[name] = np.empty((reps, max(rows, 1 << 14)), dtype)
        return arr[:, :rows]

    def mask_of(h):
        """reps x rows membership, as 0.0 and 1.0; the buffer is reused by the next call."""
        t, lo = buf("t", len(h), np.int64), buf("lo", len(h), np.int64)
        u, v = buf("u", len(h), np.uint32), buf("v", len(h), np.uint32)
        np.multiply(a, h[None, :], out=t)                    # < 2^62
        t += b
        np.bitwise_and(t, p, out=lo)
        t >>= 31
        np.add(t, lo, out=u, casting="unsafe")               # <= 2 P, so it fits 32 bits
        for _ in range(2):                                   # minus P where that is not negative, else unchanged
            np.subtract(u, np.uint32(p), out=v)
            np.minimum(u, v, out=u)
        m = buf("m", len(h), np.float64)
        np.less(u, np.uint32(threshold), out=m, casting="unsafe")
        m[0] = 1.0
        return m

    def can_win(sums):
        """(G, reps, 6) sums -> the reps of each run that the final choice may keep."""
        n, sx, sy, sxx, sxy, syy = (sums[..., i] for i in range(6))
        with np.errstate(divide="ignore", invalid="ignore"):
            dxx = n * sxx - sx * sx
            dxy = n * sxy - sx * sy
            dyy = n * syy - sy * sy
            slope = np.where((dxx > 0) & (dyy > 0), dxy / dxx, 0.0)
            sse = np.maximum((dyy - 2.0 * slope * dxy + slope * slope * dxx) / n, 0.0)
            rmse = np.where(n > 0, np.sqrt(sse / n), np.inf)
        earlier = np.minimum.accumulate(rmse, axis=1)
        first = np.ones_like(n, dtype=bool)
        first[:, 1:] = rmse[:, 1:] < earlier[:, :-1]
        return first & (rmse <= earlier[:, -1:] + 2 * 10.0 ** -digits)

    return mask_of, can_win


def run_columns(keys: Sequence[str], chunk: str = "_chunk") -> list[Column]:
    """Two hashes of (keys, chunk): rows are dealt out and sorted by the first, a single long, and told apart by both."""
    cols = [*[F.col(k) for k in keys], F.col(chunk)]
    return [F.xxhash64(*cols).alias("_g"), F.xxhash64(F.lit(1), *cols).alias("_g2")]


def _runs(emit):
    """Kernel (for mapInPandas) over rows sorted by `_g`: calls `emit(pdf, starts, ends)` with whole runs of equal
    (_g, _g2), so of one series and chunk. A run may span batches and is held back until it ends; no frame is passed on
    for None."""
    def run(batches):
        import numpy as np
        import pandas as pd

        def done(pdf):
            g, g2 = pdf["_g"].to_numpy(), pdf["_g2"].to_numpy()
            new, other = g[1:] != g[:-1], g2[1:] != g2[:-1]
            if (other & ~new).any():                         # two runs under one hash: their rows may alternate
                pdf = pdf.iloc[np.lexsort((g2, g))].reset_index(drop=True)
                g, g2 = pdf["_g"].to_numpy(), pdf["_g2"].to_numpy()
                new, other = g[1:] != g[:-1], g2[1:] != g2[:-1]
            starts = np.flatnonzero(np.concatenate([[True], new | other]))
            return emit(pdf, starts, np.append(starts[1:], len(pdf)))

        pending: list = []                                   # frames of the last run so far
        for pdf in batches:
            if pdf.empty:
                continue
            g = pdf["_g"].to_numpy()
            if pending and pending[-1]["_g"].iloc[-1] == g[-1] and g[0] == g[-1]:
                pending.append(pdf)                          # all of it goes on with that run
                continue
            last = int(np.flatnonzero(g != g[-1])[-1]) + 1 if g[0] != g[-1] else 0
            head = pd.concat([*pending, pdf.iloc[:last]], ignore_index=True) if pending else pdf.iloc[:last]
            pending = [pdf.iloc[last:]]
            if len(head) and (out := done(head.reset_index(drop=True))) is not None:
                yield out
        if pending and (out := done(pd.concat(pending, ignore_index=True))) is not None:
            yield out
    return run


def _rep_kernel(keys: list[str], rep_ids: Sequence[int], threshold: int, dense: bool, chunk_size: int = CHUNK,
                empty: bool = False):
    """Per-partition kernel for `rep_sums` (runs inside mapInPandas).

    Rows arrive in runs of one (keys, chunk), in any order within. For each run the
    sums of all reps come from one product: mask(reps x rows) @ terms(rows x 6),
    with terms (1, x, y, x^2, xy, y^2) and x counted from the chunk's begin: they
    are whole numbers and few, so every sum is exact (for |y| up to 700,000).

    With `dense` (x is the 0..n-1 position of the series), a chunk-0 run
    shorter than CHUNK is the whole series, and only the reps that can still
    win are emitted (with n_all = series length): those below every earlier
    rep's RMSE and within a few rounding steps of the least. Other runs emit
    their partial sums for every rep (n_all = count on rep 0), summed by Spark.
    The winner is chosen by the same Spark expression for either.
    """
    import numpy as np
    import pandas as pd

    reps = len(rep_ids)
    rep_col = np.arange(reps, dtype=np.int32)
    mask_of, can_win = _kernel_tools(rep_ids, threshold)

    def emit(pdf, starts, ends):
        h = pdf["_h"].to_numpy(dtype=np.int64)
        x = pdf["_x"].to_numpy(dtype=np.float64)
        y = pdf["_y"].to_numpy(dtype=np.float64)
        terms = np.column_stack([np.ones_like(x), x, y, x * x, x * y, y * y])
        mt = mask_of(h)
        sums = np.empty((len(starts), reps, 6))
        for g, (s0, s1) in enumerate(zip(starts, ends)):
            sums[g] = mt[:, s0:s1] @ terms[s0:s1]
        length = ends - starts
        chunk = pdf["_chunk"].to_numpy()[starts]
        whole = np.zeros(len(starts), dtype=bool)
        if dense:
            whole = (chunk == 0) & (length < chunk_size) & (np.maximum.reduceat(x, starts) == length - 1)
        parts = []
        if whole.any():
            at, pick = np.nonzero(can_win(sums[whole]))
            g = np.flatnonzero(whole)[at]
            sel = sums[g, pick]
            d = {c: pdf[c].take(starts[g]).to_numpy() for c in keys}
            d.update(_chunk=chunk[g], rep=rep_col[pick], n_all=length[g].astype(np.int64),
                     n=sel[:, 0].astype(np.int64), sx=sel[:, 1], sy=sel[:, 2], sxx=sel[:, 3],
                     sxy=sel[:, 4], syy=sel[:, 5])
            parts.append(d)
        if (~whole).any():
            g = np.flatnonzero(~whole)
            sel = sums[g].reshape(-1, 6)
            d = {c: np.repeat(pdf[c].take(starts[g]).to_numpy(), reps) for c in keys}
            reps_of = np.tile(rep_col, len(g))
            d.update(_chunk=np.repeat(chunk[g], reps), rep=reps_of, n_all=np.where(reps_of == 0, sel[:, 0], 0).astype(np.int64),
                     n=sel[:, 0].astype(np.int64),
                     sx=sel[:, 1], sy=sel[:, 2], sxx=sel[:, 3], sxy=sel[:, 4], syy=sel[:, 5])
            parts.append(d if empty else {c: v[d["n"] > 0] for c, v in d.items()})
        return pd.DataFrame({c: np.concatenate([d[c] for d in parts]) for c in parts[0]})

    return _runs(emit)


def rep_sums(points: DataFrame, keys: Sequence[str], reps: int = 100, frac: float = 0.7,
             x: str = "idx", y: str = "pts", engine: str = "arrow",
             dense_index: bool = False) -> DataFrame:
    """Sums per (key, rep): rep 0 is the whole series, reps 1..reps-1 are samples.

    engine="sql": each point is expanded to the reps it belongs to
    (explode + filter) and pre-aggregated by Spark's partial hash aggregate.

    engine="arrow": points are shuffled by (key, x // CHUNK) and sorted, so
    every chunk of a series is contiguous and bounded; each chunk is summed
    for all reps at once in an Arrow batch kernel, and Spark sums the chunk
    partials per (key, rep). A long series is split over many chunks/tasks.
    Same sums as the SQL formulation, several times faster.
    """
    keys = list(keys)
    exact = whole(points, x, y)
    if engine == "sql":
        h = row_hash(keys, x)
        rep = F.col("rep")
        ex = (points.where(F.col(x).isNotNull() & F.col(y).isNotNull()).select(*keys, x, y, h.alias("_h"),
                            F.explode(F.sequence(F.lit(0), F.lit(reps - 1))).alias("rep"))
              .where((rep == 0) | in_sample(F.col("_h"), rep, frac)))
        return ex.groupBy(*keys, "rep").agg(*sums(x, y, exact))
    part = _arrow_partials(points, keys, range(reps), frac, x, y, dense=False)
    return part.groupBy(*keys, "rep").agg(F.sum("n").alias("n"), *[F.sum(c).alias(c) for c in SUMS])


SUMS = ("sx", "sy", "sxx", "sxy", "syy")


def _sums_schema(key_fields: list) -> ST.StructType:
    return ST.StructType(key_fields + [
        ST.StructField("rep", ST.IntegerType()), ST.StructField("n_all", ST.LongType()), ST.StructField("n", ST.LongType())]
        + [ST.StructField(c, ST.DoubleType()) for c in SUMS])


def from_begin(chunk: int, exact: bool) -> list[Column]:
    """The sums columns of a chunk, whose x count from its begin, with x counted from the series' begin."""
    kind = "decimal(20,0)" if exact else "double"
    long = lambda c: (F.col(c).cast("bigint") if exact else F.col(c)).cast(kind)
    n, o = long("n"), (F.col("_chunk") * F.lit(chunk)).cast(kind)
    out = {"sx": long("sx") + o * n, "sy": long("sy"), "sxx": long("sxx") + F.lit(2).cast(kind) * o * long("sx") + o * o * n,
           "sxy": long("sxy") + o * long("sy"), "syy": long("syy")}
    return [(v.cast(EXACT) if exact else v).alias(c) for c, v in out.items()]


def _arrow_partials(points: DataFrame, keys: list[str], rep_ids: Sequence[int], frac: float, x: str, y: str,
                    dense: bool, chunk: int = CHUNK, extra: Sequence[str] = (), empty: bool = False, in_runs: bool = False) -> DataFrame:
    """(keys, rep, n_all, n, sums) of every chunk and rep; `extra` names key columns that are no part of the sample's
    hash; `empty`: also of samples without a point in the chunk; `in_runs`: the points come from `pieces_in_runs`."""
    threshold = int(-(-frac * P // 1))
    h = row_hash([k for k in keys if k not in extra], x)
    at = F.floor(F.col(x) / F.lit(chunk)).cast("bigint")
    pts = points.where(F.col(x).isNotNull() & F.col(y).isNotNull()).select(
        *keys, (F.col(x) - at * F.lit(chunk)).cast("double").alias("_x"), F.col(y).cast("double").alias("_y"),
        h.alias("_h"), at.alias("_chunk"), *(["_g", "_g2"] if in_runs else []))
    if not in_runs:
        pts = pts.select("*", *run_columns(keys)).repartition("_g").sortWithinPartitions("_g")
    key_fields = [f for f in pts.schema.fields if f.name in [*keys, "_chunk"]]
    part = pts.mapInPandas(_rep_kernel(keys, rep_ids, threshold, dense, chunk, empty), _sums_schema(key_fields))
    if in_runs:
        part = part.repartition(*keys)      # short series: their few sums move once, as the kernel makes them, for all that follows
    return part.select(*keys, "rep", "n_all", "n", *from_begin(chunk, whole(points, x, y)))


def pieces_in_runs(pieces: DataFrame, keys: Sequence[str], chunk: int = CHUNK, single: bool = False) -> DataFrame:
    """(keys, idx, pts) of `pieces` (keys, at, step, pts: the points at, at + step, ..; step is 1 or -1), whose rows lie as
    `_arrow_partials` deals them out: the pieces are cut at the chunks, shuffled and sorted, and only then unnested.
    `single`: a series is one piece, so its chunks are runs as they lie."""
    keys = list(keys)
    last = F.col("at") + F.col("step") * (F.size("pts") - 1)
    of = lambda x: F.floor(x / F.lit(chunk)).cast("bigint")
    low, high = F.least(F.col("at"), last), F.greatest(F.col("at"), last)
    cut = pieces.where(F.size("pts") > 0).select(*keys, "at", "step", "pts", low.alias("_low"), high.alias("_high"),
                                                 F.explode(F.sequence(of(low), of(high))).alias("_chunk"))
    begin, end = F.greatest(F.col("_low"), F.col("_chunk") * chunk), F.least(F.col("_high"), F.col("_chunk") * chunk + chunk - 1)
    start = F.when(F.col("step") > 0, begin).otherwise(end)
    cut = cut.select(*keys, "_chunk", start.alias("at"), "step",
                     F.slice("pts", (F.abs(start - F.col("at")) + 1).cast("int"), (end - begin + 1).cast("int")).alias("pts"))
    runs = cut.select("*", *run_columns(keys))
    if not single:
        runs = runs.repartition("_g").sortWithinPartitions("_g")
    return (runs.select(*keys, "_chunk", "_g", "_g2", "at", "step", F.posexplode("pts").alias("i", "pts"))
            .select(*keys, "_chunk", "_g", "_g2", (F.col("at") + F.col("step") * F.col("i")).alias("idx"), "pts"))


def _choose(models: DataFrame, keys: Sequence[str], n_all: Column) -> DataFrame:
    """The model of least RMSE (at 6 digits) of every key, the earliest rep on ties."""
    return models.groupBy(*keys).agg(
        n_all.alias("n_all"),
        F.min(F.struct(F.round("rmse", DIGITS).alias("k"), "rep", F.col("n").alias("n_fit"),
                       "slope", "intercept", "rmse", "r2")).alias("b")
    ).select(*keys, "n_all", "b.rep", "b.n_fit", "b.slope", "b.intercept", "b.rmse", "b.r2")


def fit_best_of(points: DataFrame, keys: Sequence[str], reps: int = 100, frac: float = 0.7,
                x: str = "idx", y: str = "pts", engine: str = "arrow",
                dense_index: bool = False, chunk: int = CHUNK, in_runs: bool = False) -> DataFrame:
    """Start from the full fit, keep a sample fit only if its training
    RMSE is strictly smaller; earliest wins ties (compared at 6 digits).

    `dense_index=True` promises that x is the 0..n-1 position of each series
    (as `with_sequence_index` makes it); the Arrow kernel then finishes whole
    series itself instead of handing per-rep partial sums to Spark.
    `in_runs`: the points come from `pieces_in_runs` with the same `chunk`.
    Output: keys, rep (0 = full fit), n (all points), n_fit, slope, intercept,
    rmse, r2, prediction.
    """
    keys = list(keys)
    exact = whole(points, x, y)
    if engine == "sql":
        s = rep_sums(points, keys, reps, frac, x, y, engine)
        best = _choose(s.select(*keys, "rep", "n", *model_columns(exact=exact)), keys,
                       F.max(F.when(F.col("rep") == 0, F.col("n"))))
        return _finish(best, keys, extra=["rep"])
    # One aggregation and one choice serve both kernel outputs: a whole series
    # arrives as the few reps that can win, with its length in n_all; a long
    # series as per-chunk partial rows for every rep (n_all = count on rep 0).
    part = _arrow_partials(points, keys, range(reps), frac, x, y, dense=dense_index, chunk=chunk, in_runs=in_runs)
    s = part.groupBy(*keys, "rep").agg(
        F.sum("n_all").alias("n_all"), F.sum("n").alias("n"), *[F.sum(c).alias(c) for c in SUMS])
    best = _choose(s.select(*keys, "rep", "n", "n_all", *model_columns(exact=exact)), keys, F.max("n_all"))
    return _finish(best, keys, extra=["rep"])


def fitted_values(models: DataFrame, points: DataFrame, keys: Sequence[str],
                  x: str = "idx", y: str = "pts") -> DataFrame:
    """M6: fitted value of every point under its series' model."""
    keys = list(keys)
    j = points.join(models.select(*keys, "slope", "intercept"), keys)
    return j.select(*keys, x, y, F.round(F.col("intercept") + F.col("slope") * F.col(x).cast("double"),
                                         DIGITS).alias("fitted"))
