"""Mix sources to target sizes by entropy balancing.

A document's number of copies has the prior 1/4, 1/2, 1/4 for 0, 1 and 2. Among
all distributions whose expected words meet each source's target, the one of
least relative entropy tilts the prior by ``exp(v * copies * size)`` with one
number ``v`` per source; the expected copies are then
``2 / (1 + exp(-v * size))``. `balanced` finds ``v`` by Newton's method on the
convex dual, `rounded` turns the rates into whole copies.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trailmetrics.llm.common import SPACED_WORD
from trailmetrics.runtime import Scratch

_KEY, _SIZE, _SALT, _N = "__llm_source", "__llm_size", "__llm_salt", "__llm_n"
_TILT, _TARGET, _SOURCE_SIZE, _MEAN = (
    "__llm_tilt",
    "__llm_target",
    "__llm_source_size",
    "__llm_mean",
)
# Rows of a cell, about; a source's documents of one size are dealt into more cells
# the more rows there are.
_LEAST_SALTS, _ROWS_PER_SALT = 64, 2**20
_UNIT = 1_000_000
MOST = 2


def size(text: Column) -> Column:
    """Words of a text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(SPACED_WORD)), F.lit(0)).cast("long")


def _sized(documents: DataFrame, salts: int) -> DataFrame:
    # Null is a source of its own; the first character tells it from a name.
    key = F.coalesce(F.concat(F.lit("a"), F.col("source").cast("string")), F.lit("b"))
    salt = F.pmod(F.xxhash64("doc_id", "text"), F.lit(salts))
    return documents.withColumns({_KEY: key, _SIZE: size(F.col("text")), _SALT: salt})


def source_targets(
    sizes: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5
) -> DataFrame:
    """(source key, its size) with each source's weight and target.

    Sources in the order of their keys take the weights in turn and share
    `share` times all words. No target exceeds twice its source; the excess goes
    to the others by weight. With sources ordered by how soon they are full, one
    is full exactly if the level before it would overfill it, so no loop is
    needed. One row per source passes through one task.
    """
    in_order = Window.orderBy(_KEY)
    by_fullness = Window.orderBy("full", _KEY).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    turn = F.get(F.array(*map(F.lit, weights)), F.pmod(F.row_number().over(in_order) - 1, F.lit(len(weights))))
    room = MOST * F.col(_SOURCE_SIZE)
    before = lambda column: F.coalesce(F.sum(column).over(by_fullness), F.lit(0))
    full = F.col("is_full")
    all_words = F.sum(_SOURCE_SIZE).over(everything) * F.lit(share)
    return (
        sizes.withColumn("weight", turn.cast("long"))
        .withColumn("room", room)
        .withColumn("full", F.col("room") / F.col("weight"))
        .withColumn("words", all_words)
        .withColumn("all_weight", F.sum("weight").over(everything))
        .withColumn("used", before("room"))
        .withColumn("used_weight", before("weight"))
        .withColumn(
            "is_full",
            F.col("room") * (F.col("all_weight") - F.col("used_weight"))
            <= (F.col("words") - F.col("used")) * F.col("weight"),
        )
        .withColumn("full_words", F.coalesce(F.sum(F.when(full, F.col("room"))).over(everything), F.lit(0)))
        .withColumn("open_weight", F.sum(F.when(full, 0).otherwise(F.col("weight"))).over(everything))
        .withColumn(
            _TARGET,
            F.when(full, F.col("room").cast("double")).otherwise(
                F.try_divide(
                    (F.col("words") - F.col("full_words")) * F.col("weight"), F.col("open_weight")
                )
            ),
        )
        .select(_KEY, _SOURCE_SIZE, "weight", _TARGET)
    )


def _rate() -> Column:
    """Expected copies of a document of a source."""
    whole = F.col(_TARGET) >= MOST * F.col(_SOURCE_SIZE)
    tilted = MOST / (1 + F.exp(-F.col(_TILT) * F.col(_SIZE) / F.col(_MEAN)))
    # Documents without words keep the prior's mean.
    return F.when(F.col(_SIZE) == 0, 1.0).when(whole, float(MOST)).otherwise(tilted)


def _newton_step(state: DataFrame, histogram: DataFrame) -> DataFrame:
    """One step of every source at once.

    From 0 the steps approach the solution from one side, because the expected
    words are concave in the tilt above 0 and convex below.
    """
    rate, words = _rate(), F.col(_N) * F.col(_SIZE)
    slope = words * F.col(_SIZE) / F.col(_MEAN) * rate * (MOST - rate) / MOST
    # Every source of the state has sizes, so grouping by its columns uses it once.
    sums = (
        histogram.join(state, _KEY)
        .groupBy(_KEY, _SOURCE_SIZE, _TARGET, _MEAN, _TILT)
        .agg(F.sum(words * rate).alias("__llm_words"), F.sum(slope).alias("__llm_slope"))
    )
    error = F.col(_TARGET) - F.col("__llm_words")
    step = F.coalesce(F.try_divide(error, F.col("__llm_slope")), F.lit(0.0))
    open_ = F.col(_TARGET) < MOST * F.col(_SOURCE_SIZE)
    return sums.select(
        _KEY,
        _SOURCE_SIZE,
        _TARGET,
        _MEAN,
        (F.col(_TILT) + F.when(open_, step).otherwise(0.0)).alias(_TILT),
        F.when(open_, F.abs(F.try_divide(error, F.col(_TARGET)))).otherwise(0.0).alias("__llm_error"),
    )


def balanced(
    histogram: DataFrame,
    targets: DataFrame,
    scratch: Scratch,
    tolerance: float = 1e-6,
    steps_per_round: int = 4,
) -> DataFrame:
    """The tilt of each source, from its counts of documents by size.

    Every round runs some Newton steps and writes its result, one row per
    source; the rounds end when each source's words are within `tolerance` of
    its target. As the steps come nearer from one side, a round that comes no
    nearer has met the limits of floating point, which is an error.
    """
    means = histogram.groupBy(_KEY).agg(
        (F.sum(F.col(_N) * F.col(_SIZE)) / F.sum(_N)).alias(_MEAN)
    )
    state = targets.join(means, _KEY).select(
        _KEY,
        _SOURCE_SIZE,
        _TARGET,
        F.when(F.col(_MEAN) > 0, F.col(_MEAN)).otherwise(1.0).alias(_MEAN),
        F.lit(0.0).alias(_TILT),
    )
    number, before = 0, None
    while True:
        for _ in range(steps_per_round):
            state = _newton_step(state, histogram)
        state = scratch.write(state, f"tilts_{number}")
        if number:
            scratch.drop(f"tilts_{number - 1}")
        error = state.agg(F.max("__llm_error")).first()[0] or 0.0
        if error <= tolerance:
            return state.drop("__llm_error")
        if before is not None and error >= before:
            raise RuntimeError(f"the mix misses a target by a share of {error}")
        number, before = number + 1, error


def rounded(cells: DataFrame, tilts: DataFrame) -> DataFrame:
    """Whole copies for each cell of documents of a source, a size and a salt.

    A cell gets the difference of the rounded running sums of expected copies,
    from large sizes to small, so the words taken from a source miss its target
    by half its largest document at most, and mostly by far less. Sums are of whole millionths, which
    any order of adding gives alike. The running sum is split into classes of
    size, so that no task needs all cells of a source.
    """
    expected = F.round(_rate() * _UNIT).cast("long") * F.col(_N)
    octave = F.floor(F.log2(F.col(_SIZE) + 1) * 16)
    cells = cells.join(tilts, _KEY).withColumns(
        {"__llm_expected": expected, "__llm_class": octave}
    )
    classes = Window.partitionBy(_KEY).orderBy(F.desc("__llm_class"))
    before = (
        cells.groupBy(_KEY, "__llm_class")
        .agg(F.sum("__llm_expected").alias("__llm_sum"))
        .select(
            _KEY,
            "__llm_class",
            (F.sum("__llm_sum").over(classes) - F.col("__llm_sum")).alias("__llm_before"),
        )
    )
    in_class = (
        Window.partitionBy(_KEY, "__llm_class")
        .orderBy(F.desc(_SIZE), _SALT)
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    upto = F.col("__llm_before") + F.sum("__llm_expected").over(in_class)
    return (
        cells.join(before, [_KEY, "__llm_class"])
        .withColumn("__llm_upto", upto)
        .withColumn(
            "__llm_copies",
            F.expr(
                f"(__llm_upto + {_UNIT // 2}) div {_UNIT}"
                f" - (__llm_upto - __llm_expected + {_UNIT // 2}) div {_UNIT}"
            ),
        )
        .select(_KEY, _SIZE, _SALT, _N, _SOURCE_SIZE, _TARGET, _rate().alias("__llm_rate"), "__llm_copies")
    )


def mix(
    documents: DataFrame,
    scratch: Scratch,
    carry: tuple[str, ...] | None = None,
    weights: tuple[int, ...] = (5, 2, 1),
    share: float = 1.5,
) -> DataFrame:
    """How often the mix takes each row of `documents`.

    Returns the columns `carry` (all, if not given) and, with names that begin
    with ``__llm_``: size, source_size, target, rate and copies (0, 1 or 2).
    Within a cell of equal source and size, copies go to documents in the order
    of a hash of doc_id and text, so reruns agree, also where ids are null or
    repeated.

    A null or empty text has size 0 and rate 1; null sources are one source,
    the last. A text of any length is counted whole, and is one row in its cell.
    Repeated rows count and are taken one by one. Other columns pass unchanged.
    An empty table stays empty.
    """
    sized = _sized(documents, max(_LEAST_SALTS, documents.count() // _ROWS_PER_SALT))
    cells = scratch.write(
        sized.groupBy(_KEY, _SIZE, _SALT).agg(F.count("*").alias(_N)), "mix_cells"
    )
    histogram = scratch.write(
        cells.groupBy(_KEY, _SIZE).agg(F.sum(_N).alias(_N)), "mix_histogram"
    )
    sizes = histogram.groupBy(_KEY).agg(F.sum(F.col(_N) * F.col(_SIZE)).alias(_SOURCE_SIZE))
    targets = scratch.write(source_targets(sizes, weights, share), "mix_targets")
    tilts = balanced(histogram, targets.drop("weight"), scratch)
    copies = scratch.write(rounded(cells, tilts), "mix_copies")
    carried = documents.columns if carry is None else list(carry)
    order = Window.partitionBy(_KEY, _SIZE, _SALT).orderBy(
        "__llm_order", "__llm_doc", "__llm_text"
    )
    every = F.floor(F.col("__llm_copies") / F.col(_N))
    more = F.col("__llm_copies") - every * F.col(_N)
    return (
        sized.withColumns(
            {
                "__llm_order": F.xxhash64("doc_id", F.lit(1)),
                "__llm_doc": F.col("doc_id"),
                "__llm_text": F.xxhash64("text"),
            }
        )
        .select(
            *[f"`{c}`" for c in carried],
            _KEY,
            _SIZE,
            _SALT,
            "__llm_order",
            "__llm_doc",
            "__llm_text",
        )
        .withColumn("__llm_rank", F.row_number().over(order))
        .join(copies, [_KEY, _SIZE, _SALT])
        .withColumn("__llm_taken", (every + (F.col("__llm_rank") <= more).cast("long")).cast("int"))
        .select(
            *[f"`{c}`" for c in carried],
            _SIZE,
            _SOURCE_SIZE,
            _TARGET,
            "__llm_rate",
            F.col("__llm_taken").alias("__llm_copies"),
        )
    )


def mixed(documents: DataFrame, scratch: Scratch) -> DataFrame:
    """The mix itself: each document as often as it is taken, numbered by `copy`."""
    kept = [c for c in documents.columns if c != "copy"]
    return (
        mix(documents, scratch, tuple(kept))
        .where(F.col("__llm_copies") > 0)
        .select(*[f"`{c}`" for c in kept], F.explode(F.sequence(F.lit(1), F.col("__llm_copies"))).alias("copy"))
    )
