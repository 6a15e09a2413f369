"""Toxicity: class-conditional Kneser-Ney models of the characters of words.

Two models give the likelihood of a word, one learned from toxic and one from ordinary documents. They are interpolated
Kneser-Ney models of `order` characters within a word. The highest order counts occurrences per class, lower ones count
the distinct characters before an n-gram per class, and the lowest `shared` orders count those over all documents,
labelled or not: what is rare in both classes then gets the same probability from both. A document's evidence is the
length-normalised sum of its words' log-likelihood ratios as far as they exceed a margin, and the mean of its strongest
words, so that a toxic sentence counts in a long text, too. Logistic calibration on labelled rows that were not counted
turns the evidence into a score.

Counts grow with the corpus and are never held in one place:

1. Scan tasks cut their rows into blocks of bounded size, give each distinct word of a block a number, and store the
   blocks, bucketed. Labels meet the ids of the rows, not the texts.
2. Each block sends its distinct n-grams with their counts by class; owners add them up, and the models are joins and
   sums over the distinct n-grams of the corpus.
3. The log-ratios go back to the blocks that asked, which are scored in their buckets. Texts are never shuffled.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from personweave.llm.quality import held_out
from personweave.sources.scratch import scratch_root, scratch_table

BLOCK_BYTES = 16 << 20
MAX_BUCKETS = 50_000
BLOCK = "block long, doc_ids array<long>, sizes array<long>, words binary, codes binary"
START, END = "\x02", "\x03"  # around a word; control characters are no part of words
_ODD = np.uint64(0x9E3779B97F4A7C15)
# ASCII letters and digits are kept, other ASCII characters separate words, all else belongs to words.
_SEPARATE = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))
TRAIN, CALIBRATE = 0, 2  # added to the label: what a labelled row is used for


@dataclass(frozen=True)
class Settings:
    """Log-ratios count beyond `margin`; with a `length_power` of 1 their sum becomes a mean, with less a few strong words
    of a long text weigh more. `strongest` words make the second part of the evidence. One in `calibrate_one_in` labelled
    rows calibrates, the others are counted; `bins` is the grid of either part that calibration gathers."""
    order: int = 5
    shared: int = 3
    margin: float = 2.0
    length_power: float = 0.75
    strongest: int = 3
    calibrate_one_in: int = 5
    bins: int = 100


def words_of(text: str | None) -> list[bytes]:
    """Lower-case words as UTF-8."""
    return (text or "").lower().encode().translate(_SEPARATE).split()


class _Numbers(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    number = TaskContext.get().partitionId() << 20
    ids, sizes, codes, known, size = [], [], [], _Numbers(), 0

    def block() -> pa.RecordBatch:
        kinds = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary(), pa.binary()]
        row = [number, ids, sizes, b" ".join(known), b"".join(codes)]
        return pa.RecordBatch.from_arrays([pa.array([x], kind) for x, kind in zip(row, kinds)],
                                          ["block", "doc_ids", "sizes", "words", "codes"])

    for batch in batches:
        for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"]):
            text = text.as_py()
            words = words_of(text)
            ids.append(doc_id)
            sizes.append(len(words))
            codes.append(np.fromiter(map(known.__getitem__, words), "<u4", len(words)).tobytes())
            size += len(text or "") + 16
            if size >= BLOCK_BYTES:
                yield block()
                number += 1
                ids, sizes, codes, known, size = [], [], [], _Numbers(), 0
    if ids:
        yield block()


def _grams(words: bytes, order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For the words of a block: the distinct n-grams as code points; for every place which of them and of which word
    it is; where the places of each word begin."""
    if not words:
        none = np.empty(0, np.int64)
        return np.empty((0, order), np.uint32), none, none, none
    pad = START * (order - 1)
    text = pad + words.decode().replace(" ", END + pad) + END
    points = np.frombuffer(text.encode("utf-32-le"), "<u4")
    places = np.flatnonzero(points != ord(START))
    h = np.zeros(len(places), np.uint64)
    for back in reversed(range(order)):
        h = (h ^ points[places - back]) * _ODD
        h ^= h >> np.uint64(29)
    _, first, which = np.unique(h, return_index=True, return_inverse=True)
    ends = np.flatnonzero(points[places] == ord(END))
    starts = np.concatenate(([0], ends[:-1] + 1))
    word = np.repeat(np.arange(len(ends)), np.diff(np.append(starts, len(places))))
    return points[places[first][:, None] + np.arange(1 - order, 1)], which, word, starts


def _uses(pairs: list[dict] | None, rows: int) -> np.ndarray:
    """What each row of a block is used for, -1 for none."""
    out = np.full(rows, -1, np.int8)
    for pair in pairs or ():
        out[pair["slot"]] = pair["use"]
    return out


def _counted(order: int):
    """The n-grams of each block in the order of their slots, with their counts in toxic and ordinary training rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                grams, which, word, _ = _grams(row["words"], order)
                n = len(grams)
                if not n:
                    continue
                codes, sizes = np.frombuffer(row["codes"], "<u4"), np.array(row["sizes"], np.int64)
                use = np.repeat(_uses(row["uses"], len(sizes)), sizes)
                counts = []
                for label in (1, 0):
                    of_word = np.bincount(codes[use == TRAIN + label], minlength=word[-1] + 1)
                    counts.append(np.bincount(which, of_word[word], n).astype(np.int64))
                text = np.ascontiguousarray(grams).view(f"<U{order}").ravel()
                for at in range(0, n, 1 << 16):
                    part = slice(at, min(n, at + (1 << 16)))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(part.stop - at, row["block"], np.int64)), pa.array(np.arange(at, part.stop, dtype=np.int32)),
                         pa.array(text[part].tolist(), pa.string()), pa.array(counts[0][part]), pa.array(counts[1][part])],
                        ["block", "slot", "gram", "toxic", "ordinary"])
    return run


def _scored(settings: Settings):
    """`doc_id`, both parts of the evidence and `use` of every row of the blocks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, row in enumerate(batch.drop_columns(["ratios"]).to_pylist()):
                grams, which, _, starts = _grams(row["words"], settings.order)
                answer = batch["ratios"][at].values
                of_word = np.add.reduceat(answer.to_numpy().astype(float)[which], starts) if len(starts) else np.empty(0)
                assert answer is None or len(answer) == len(grams)  # every n-gram of the block has its ratio
                values = of_word[np.frombuffer(row["codes"], "<u4")]
                sizes = np.array(row["sizes"], np.int64)
                parts = np.array([evidence(v, settings) for v in np.split(values, np.cumsum(sizes)[:-1])])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["doc_ids"], pa.int64()), pa.array(parts[:, 0].copy()), pa.array(parts[:, 1].copy()),
                     pa.array(_uses(row["uses"], len(sizes)).astype(np.int64))], ["doc_id", "excess", "strongest", "use"])
    return run


def evidence(ratios: np.ndarray, settings: Settings) -> tuple[float, float]:
    """Of the log-ratios of a text's words: the logs of 1 + the normalised sum beyond the margin, and of 1 + the mean of the
    strongest. 0 and 0 without words."""
    if not len(ratios):
        return 0.0, 0.0
    excess = np.maximum(ratios - settings.margin, 0).sum() / (len(ratios) + 8) ** settings.length_power
    k = min(settings.strongest, len(ratios))
    strongest = np.partition(ratios, len(ratios) - k)[-k:].mean()
    return float(np.log1p(8 * excess)), float(np.log1p(max(strongest, 0.0)))


def _levels(grams: DataFrame, order: int) -> list[DataFrame]:
    """`gram`, `toxic`, `ordinary`, `all` for n-grams of length 1 to `order`: occurrences at the top, below it the number of
    distinct longer n-grams that end so."""
    levels = [grams]
    for size in range(order - 1, 0, -1):
        longer = levels[0]
        levels.insert(0, scratch_table(longer.groupBy(F.substring("gram", 2, size).alias("gram")).agg(
            F.count_if(F.col("toxic") > 0).alias("toxic"), F.count_if(F.col("ordinary") > 0).alias("ordinary"),
            F.count("*").alias("all")), f"grams-{size}"))
    return levels


def _discounts(levels: list[DataFrame]) -> list[dict[str, float]]:
    """The discount of each count of each level, from how many n-grams were counted once and twice."""
    names = ("toxic", "ordinary", "all")
    rows = None
    for number, level in enumerate(levels):
        one = level.agg(F.lit(number).alias("level"), *[F.count_if(F.col(c) == k).alias(f"{c}{k}") for c in names for k in (1, 2)])
        rows = one if rows is None else rows.unionByName(one)
    found = {r["level"]: r for r in rows.collect()}  # one row per level
    return [{c: (found[i][f"{c}1"] / (found[i][f"{c}1"] + 2 * found[i][f"{c}2"]) if found[i][f"{c}1"] else 0.5) for c in names}
            for i in range(len(levels))]


def log_ratios(grams: DataFrame, settings: Settings) -> DataFrame:
    """`gram`, `ratio`: the log of the ratio of the two models' probabilities of an n-gram's last character.

    `grams` has the distinct n-grams of the highest order with `toxic` and `ordinary` counts."""
    levels = _levels(grams.withColumn("all", F.lit(1).cast("long")), settings.order)
    discounts = _discounts(levels)
    lower = None
    letters = max(1, levels[0].count())
    for number, (level, discount) in enumerate(zip(levels, discounts)):
        size = number + 1
        same = Window.partitionBy(F.substring("gram", 1, size - 1))  # at most one row per character

        def probability(count: str, below: Column) -> Column:
            total, kinds = F.sum(count).over(same), F.count_if(F.col(count) > 0).over(same)
            taken = F.greatest(F.col(count) - discount[count], F.lit(0.0)) + discount[count] * kinds * below
            return F.when(total > 0, taken / total).otherwise(below)

        if lower is None:
            below = {c: F.lit(1.0 / letters) for c in ("p_toxic", "p_ordinary")}
            joined = level
        else:
            below = {c: F.col(c) for c in ("p_toxic", "p_ordinary")}
            joined = level.join(lower.withColumnRenamed("gram", "shorter"), F.substring("gram", 2, size) == F.col("shorter"))
        of = {"p_toxic": "all", "p_ordinary": "all"} if size <= settings.shared else {"p_toxic": "toxic", "p_ordinary": "ordinary"}
        lower = joined.select("gram", *[probability(count, below[p]).alias(p) for p, count in of.items()])
        if size < settings.order:
            lower = scratch_table(lower, f"probabilities-{size}")
    return lower.select("gram", (F.log("p_toxic") - F.log("p_ordinary")).alias("ratio"))


def calibration(cells: list[tuple[float, float, int, int]], prior: float) -> np.ndarray:
    """Two slopes and an intercept of a logistic model of (excess, strongest, rows, toxic rows), drawn a little towards
    slopes of 1 and the prior odds, so that it exists for any rows."""
    a, b, n, y = np.array(cells, float).T if cells else np.zeros((4, 0))
    prior = min(max(prior, 1e-3), 1 - 1e-3)
    start = np.array([1.0, 1.0, np.log(prior / (1 - prior))])
    design, w, pull = np.stack([a, b, np.ones(len(a))], axis=1), start, 0.01

    def loss(w: np.ndarray) -> float:
        z = design @ w
        return float((n * np.logaddexp(0, z) - y * z).sum() + pull * ((w - start) ** 2).sum() / 2)

    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -500, 500)))
        gradient = design.T @ (n * p - y) + pull * (w - start)
        step = np.linalg.solve(design.T @ (design * (n * p * (1 - p))[:, None]) + pull * np.eye(3), gradient)
        size = 1.0
        while size > 1e-6 and loss(w - size * step) > loss(w):
            size /= 2
        w = w - size * step
        if np.abs(size * step).max() < 1e-9:
            break
    return w


def _stored(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The blocks of `docs`, bucketed by block."""
    spark = docs.sparkSession
    texts = docs.select(docs[f"`{id_col}`"].cast("long").alias("doc_id"), docs[f"`{text_col}`"].cast("string").alias("text"))
    name = f"toxicity_{uuid.uuid4().hex}"
    path = f"{scratch_root(spark)}/{spark.sparkContext.applicationId}/{name}"
    buckets = min(MAX_BUCKETS, max(1, texts.rdd.getNumPartitions()))
    (texts.mapInArrow(_blocks, BLOCK).write.bucketBy(buckets, "block").option("path", path).option("compression", "zstd")
     .saveAsTable(name))
    blocks = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # the catalog forgets it, the files stay for the plans below
    return blocks


def toxicity_evidence(docs: DataFrame, labels: DataFrame, settings: Settings = Settings(), id_col: str = "doc_id",
                      text_col: str = "text", label_col: str = "toxic") -> DataFrame:
    """`doc_id`, `excess`, `strongest`, `use` of every row of `docs`; `use` is 0 or 1 for rows that were counted (label 0 or 1), 2 or 3
    for those kept for calibration, -1 for others."""
    blocks = _stored(docs, id_col, text_col)
    doc_id = F.col("doc_id")
    known = (labels.select(labels[f"`{id_col}`"].cast("long").alias("doc_id"), labels[f"`{label_col}`"].alias("label"))
             .where(F.col("label").isin(0, 1) & doc_id.isNotNull() & ~held_out(doc_id))
             .groupBy("doc_id").agg(F.max("label").cast("long").alias("label")))
    spared = F.pmod(F.xxhash64("doc_id", F.lit("calibrate")), F.lit(settings.calibrate_one_in)) == 0
    known = known.select("doc_id", (F.col("label") + F.when(spared, CALIBRATE).otherwise(TRAIN)).alias("use"))
    uses = scratch_table(blocks.select("block", F.posexplode("doc_ids").alias("slot", "doc_id")).join(known, "doc_id")
                         .groupBy("block").agg(F.collect_list(F.struct("slot", "use")).alias("uses")), "toxicity_uses")
    used = blocks.join(uses.hint("shuffle_hash"), "block", "left")
    sent = scratch_table(used.select("block", "sizes", "words", "codes", "uses").mapInArrow(
        _counted(settings.order), "block long, slot int, gram string, toxic long, ordinary long"), "toxicity_grams", "zstd")
    grams = scratch_table(sent.groupBy("gram").agg(F.sum("toxic").alias("toxic"), F.sum("ordinary").alias("ordinary")), "grams")
    ratios = log_ratios(grams, settings)
    # Ratios by slot. Stored first, so that they are dealt into the buckets of the blocks and not the blocks anew.
    answers = scratch_table(sent.select("block", "slot", "gram").join(ratios, "gram")
                            .groupBy("block").agg(F.array_sort(F.collect_list(F.struct("slot", F.col("ratio").cast("float").alias("ratio")))).alias("pairs"))
                            .select("block", F.col("pairs.ratio").alias("ratios")), "toxicity_ratios", "zstd")
    met = used.join(answers.hint("shuffle_hash"), "block", "left")
    return met.select("doc_ids", "sizes", "words", "codes", "uses", "ratios").mapInArrow(
        _scored(settings), "doc_id long, excess double, strongest double, use long")


def toxicity_scores(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, settings: Settings = Settings(),
                    id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> DataFrame:
    """`doc_id`, `held_out`, `score`, `predicted`, `excess`, `strongest` for every row of `docs`.

    Held-out rows (crc32 of the id modulo 5 is 0, or no id) are never learned from; all other labelled rows are. Scores
    depend on the text alone. Null texts count as empty; texts without a word have no evidence. Of several labels of one
    id the highest counts; labels other than 0 and 1 are ignored. Without any usable label the score of a
    text without evidence is 0.001. Repeated rows get equal scores, an empty table gives an empty result, other columns
    are ignored. Texts are read whole, whatever their length.
    """
    found = scratch_table(toxicity_evidence(docs, labels, settings, id_col, text_col, label_col), "toxicity")
    parts = ("excess", "strongest")
    facts = found.where("use >= 0").agg(F.avg(F.col("use") % 2).alias("prior"), *[f(c).alias(f"{f.__name__}_{c}") for c in parts
                                                                              for f in (F.min, F.max)]).first()
    bin_of = []
    for c in parts:
        low, high = facts[f"min_{c}"] or 0.0, facts[f"max_{c}"] or 0.0
        bin_of.append(F.floor((F.col(c) - low) / max((high - low) / settings.bins, 1e-9)).alias(f"bin_{c}"))
    # At most (bins + 1) ** 2 rows, whatever the corpus.
    cells = (found.where(F.col("use") >= CALIBRATE).groupBy(*bin_of)
             .agg(F.avg("excess").alias("a"), F.avg("strongest").alias("b"), F.count("*").alias("n"), F.sum(F.col("use") % 2).alias("y"))
             .orderBy("bin_excess", "bin_strongest").collect())
    first, second, intercept = calibration([(r["a"], r["b"], r["n"], r["y"]) for r in cells], facts["prior"] or 0.0).tolist()
    score = 1 / (1 + F.exp(-(F.col("excess") * first + F.col("strongest") * second + intercept)))
    return (found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score.alias("score"), *parts)
            .withColumn("predicted", (F.col("score") >= threshold).cast("int"))
            .select("doc_id", "held_out", "score", "predicted", *parts))
