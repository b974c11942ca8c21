"""A convolutional text classifier, trained in numpy by shards of the labelled rows and applied in Arrow batches.

Words are hashed to rows of an embedding table, filters of several widths slide over
them, each filter's best place in the text counts, and one layer on top gives the score.
Thresholds are calibrated by language, as the text itself shows it, and moved into the
score, so that one half is the threshold everywhere.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from copy import deepcopy
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridgale.llm.common import written

BUCKETS = 1 << 18
DIM = 8
WIDTHS = (1, 2, 3)
FILTERS = 16
SHARD_ROWS = 12_000  # labelled rows that one task trains on
UNIT = 1 << 24  # sums over shards are of whole multiples of its inverse, so that they come out the same in any order
BINS = 1 << 10  # parts of one in which logits are told apart for thresholds
EPOCHS = 6
BATCH = 64
SEEN = 3  # texts of the sample in which a row of the table must occur; other rows stay blank
DROPPED = 0.2  # of the words of a text, anew in each training step
SEGMENT = 1 << 16  # words worked on at a time in a very long text
CHUNK = 1 << 17
FOLDS = 5
TOKEN = r"[\p{L}\p{N}']+"

# Frequent words that tell languages apart.
FUNCTION_WORDS = {
    "en": "the of and to in is that was for with this are be on by",
    "de": "der die das und den von mit ist ein eine nicht zu auf im sich",
    "fr": "le la les des et est une dans que qui pour par sur avec du",
    "es": "el los las de y en que por con una para del se su al",
}


def token_hashes(text: Column) -> Column:
    """A 64-bit hash for each word of the lower-cased text; of null, none."""
    tokens = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(TOKEN), F.lit(0))
    return F.transform(tokens, lambda t: F.xxhash64(t))


def held_out(key: Column) -> Column:
    """Rows that no model learns from; a null key counts as empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % FOLDS == 0


def _places(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    h = hashes.view(np.uint64)
    return (h & np.uint64(BUCKETS - 1)).astype(np.int32), ((h >> np.uint64(40)) & np.uint64(BUCKETS - 1)).astype(np.int32)


def _language_table() -> np.ndarray:
    table = np.zeros((len(FUNCTION_WORDS), BUCKETS), bool)
    for i, text in enumerate(FUNCTION_WORDS.values()):
        for word in text.split():
            table[i, xxhash.xxh64_intdigest(word.encode(), 42) & (BUCKETS - 1)] = True
    return table


def languages(hashes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The language whose function words each text has most of; -1 where it has none. Worked on CHUNK words at a time:
    running counts over all words of a batch would take many times its own memory."""
    out = np.full(len(starts) - 1, -1)
    if not len(hashes):
        return out
    table, votes = _language_table(), np.zeros((len(FUNCTION_WORDS), len(out)), np.int64)
    for begin in range(0, len(hashes), CHUNK):
        first, bounds = _places(hashes[begin : begin + CHUNK])[0], starts - begin
        for row, of in zip(table, votes):
            of += np.diff(np.searchsorted(np.flatnonzero(row[first]), bounds))
    return np.where(votes.max(axis=0) > 0, votes.argmax(axis=0), -1)


@dataclass
class Model:
    words: np.ndarray  # (BUCKETS + 1, DIM); the last row stands beyond the end of a text
    filters: list[np.ndarray]  # per width (width * DIM, FILTERS)
    offsets: list[np.ndarray]
    top: np.ndarray
    bias: float
    thresholds: np.ndarray  # logits per language, the last for unknown ones

    def views(self, hashes: np.ndarray, starts: np.ndarray):
        """Words in rows, with blank rows after each text, and where its windows begin and end: at each word,
        or at the first blank row of a text without words. No window meets two texts."""
        gap = max(WIDTHS)
        n = np.diff(starts)
        begins = starts[:-1] + gap * np.arange(len(n))
        at = np.arange(len(hashes)) + gap * np.repeat(np.arange(len(n)), n)
        size = len(hashes) + gap * len(n) + gap
        one, two = np.full(size, BUCKETS, np.int32), np.full(size, BUCKETS, np.int32)
        one[at], two[at] = _places(hashes)
        rows = self.words[one] + self.words[two]
        return one, two, rows, begins, begins + np.maximum(n, 1)

    def pooled(self, hashes: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Each filter's best place per text; texts are of SEGMENT words at most."""
        _, _, rows, begins, ends = self.views(hashes, starts)
        size = len(rows) - max(WIDTHS) + 1
        runs = np.stack([begins, ends], axis=1).ravel()
        out = []
        for width, w, b in zip(WIDTHS, self.filters, self.offsets):
            wide = rows[:size] @ w[:DIM]
            for j in range(1, width):
                wide += rows[j : size + j] @ w[j * DIM : (j + 1) * DIM]
            out.append(np.maximum(np.maximum.reduceat(wide, runs, axis=0)[::2] + b, 0))
        return np.concatenate(out, axis=1)

    def logits(self, hashes: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Before calibration; a text without words has the bias alone behind it."""
        gap = max(WIDTHS) - 1
        n = np.diff(starts)
        parts = np.maximum(1, -(-n // SEGMENT))
        of = np.repeat(np.arange(len(n)), parts)
        begin = starts[:-1][of] + (np.arange(len(of)) - np.repeat(np.cumsum(parts) - parts, parts)) * SEGMENT
        end = np.minimum(begin + SEGMENT + gap, starts[1:][of])
        best = np.zeros((len(n), len(self.top)), np.float32)
        weight = np.cumsum(end - begin)
        cuts = np.unique(np.searchsorted(weight, np.arange(CHUNK, weight[-1] if len(weight) else 0, CHUNK)))
        for a, b in zip([0, *cuts], [*cuts, len(of)]):
            if a < b:
                sizes = (end - begin)[a:b]
                bounds = np.concatenate([[0], np.cumsum(sizes)])
                at = np.repeat(begin[a:b] - bounds[:-1], sizes) + np.arange(bounds[-1])
                np.maximum.at(best, of[a:b], self.pooled(hashes[at], bounds))
        return best @ self.top + self.bias

    def scores(self, hashes: np.ndarray, starts: np.ndarray) -> np.ndarray:
        shifted = self.logits(hashes, starts) - self.thresholds[languages(hashes, starts)]
        return 1 / (1 + np.exp(-np.clip(shifted.astype(np.float64), -40, 40)))


def _counted(texts: list[np.ndarray], labels: np.ndarray) -> np.ndarray:
    """By label and row of the table, the texts in which it occurs."""
    counts = np.zeros((2, BUCKETS + 1), np.int64)
    for text, label in zip(texts, labels):
        for places in _places(np.unique(text)):
            counts[label, np.unique(places)] += 1
    return counts


def _begun(counts: np.ndarray, rows: np.ndarray, seed: int = 5) -> Model:
    """A model whose first embedding column is what a word alone says about the label."""
    rng = np.random.default_rng(seed)
    rows = rows[:, None]
    odds = np.log((counts + 0.5) / (rows + 1))
    words = rng.normal(0, 0.05, (BUCKETS + 1, DIM))
    words[:, 0] = (odds[1] - odds[0]) / 4
    words[counts.sum(axis=0) < SEEN] = 0
    filters = [rng.normal(0, 0.2, (w * DIM, FILTERS)) for w in WIDTHS]
    filters[0][0, : FILTERS // 2] += 0.5
    return Model(
        words.astype(np.float32), [f.astype(np.float32) for f in filters], [np.zeros(FILTERS, np.float32) for _ in WIDTHS],
        rng.normal(0, 0.1, FILTERS * len(WIDTHS)).astype(np.float32), 0.0, np.zeros(len(FUNCTION_WORDS) + 1),
    )


def train(model: Model, texts: list[np.ndarray], labels: np.ndarray, rows: np.ndarray, seed: int, epochs: int) -> None:
    """Gradient steps over mini-batches; both classes, of `rows` in all shards, weigh the same. Only the best place of each
    filter is learned from."""
    rng = np.random.default_rng(seed)
    dense = [*model.filters, *model.offsets, model.top]
    first, second = [np.zeros_like(p) for p in dense], [np.zeros_like(p) for p in dense]
    squares = np.full(BUCKETS + 1, 1e-6, np.float32)
    blank = ~model.words.any(axis=1)
    weights = rows.sum() / (2 * rows)
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(texts))
        for begin in range(0, len(order), BATCH):
            chosen = order[begin : begin + BATCH]
            y = labels[chosen]
            left = [texts[i][rng.random(len(texts[i])) >= DROPPED] for i in chosen]
            hashes = np.concatenate(left)
            starts = np.concatenate([[0], np.cumsum([len(t) for t in left])])
            one, two, rows, begins, ends = model.views(hashes, starts)
            size = len(rows) - max(WIDTHS) + 1
            best, pooled = [], []
            for width, w, b in zip(WIDTHS, model.filters, model.offsets):
                wide = sum(rows[j : size + j] @ w[j * DIM : (j + 1) * DIM] for j in range(width))
                at = np.stack([p + wide[p:e].argmax(axis=0) for p, e in zip(begins, ends)])
                best.append(at)
                pooled.append(np.maximum(np.take_along_axis(wide, at, axis=0) + b, 0))
            features = np.concatenate(pooled, axis=1)
            logit = features @ model.top + model.bias
            error = ((1 / (1 + np.exp(-np.clip(logit, -30, 30))) - y) * weights[y] / len(y)).astype(np.float32)
            back = error[:, None] * model.top * (features > 0)
            grads = [np.zeros_like(p) for p in dense]
            grads[-1] = features.T @ error
            to_words = np.zeros_like(rows)
            for k, (width, w) in enumerate(zip(WIDTHS, model.filters)):
                g = back[:, k * FILTERS : (k + 1) * FILTERS]
                grads[len(WIDTHS) + k] = g.sum(axis=0)
                for j in range(width):
                    part = slice(j * DIM, (j + 1) * DIM)
                    grads[k][part] = np.einsum("bf,bfd->df", g, rows[best[k] + j])
                    np.add.at(to_words, (best[k] + j).ravel(), (g[:, :, None] * w[part].T[None]).reshape(-1, DIM))
            step += 1
            for p, g, m, s in zip(dense, grads, first, second):
                m += 0.1 * (g - m)
                s += 0.001 * (g * g - s)
                p -= 0.01 * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.999**step)) + 1e-8)
            model.bias -= 0.01 * float(error.sum()) * 10
            moved = np.flatnonzero(np.abs(to_words).sum(axis=1))
            for places in (one[moved], two[moved]):
                squares_now = (to_words[moved] ** 2).mean(axis=1)
                np.add.at(squares, places, squares_now)
                np.add.at(model.words, places, -0.05 * to_words[moved] / np.sqrt(squares[places])[:, None])
            model.words[np.concatenate([one, two])] *= ~blank[np.concatenate([one, two])][:, None]


def _flat(model: Model) -> np.ndarray:
    """All that gradients move, in rows of DIM: the embedding table, then the rest."""
    rest = np.concatenate([p.ravel() for p in (*model.filters, *model.offsets, model.top, np.array([model.bias]))])
    return np.concatenate([model.words, np.resize(rest, (-(-len(rest) // DIM), DIM))]).astype(np.float64)


def _moved(model: Model, by: np.ndarray) -> None:
    """Add `by`, in the form of `_flat`."""
    model.words += by[: BUCKETS + 1].astype(np.float32)
    rest = by[BUCKETS + 1 :].ravel()
    for p in (*model.filters, *model.offsets, model.top):
        p += rest[: p.size].reshape(p.shape).astype(np.float32)
        rest = rest[p.size :]
    model.bias += float(rest[0])


def _by_shard(work: Callable[[list[np.ndarray], np.ndarray], dict]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """`work` on the texts and labels of each shard, whose rows follow one another."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, texts, labels = None, [], []

        def done() -> Iterator[pa.RecordBatch]:
            if labels:
                yield from pa.table(work(texts, np.array(labels, np.int64))).to_batches()

        for batch in batches:
            for shard, label, text in zip(batch["shard"].to_pylist(), batch["label"].to_pylist(), batch["hashes"]):
                if shard != at:
                    yield from done()
                    at, texts, labels = shard, [], []
                texts.append(text.values.to_numpy())  # where it lies in the batch, not copied
                labels.append(label)
        yield from done()

    return run


def _summed(parts: DataFrame, columns: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """`place` and the sums of the columns over all shards; no more rows than the model has."""
    total = parts.groupBy("place").agg(*[F.sum(c).alias(c) for c in columns]).toArrow()
    return total["place"].to_numpy(), np.stack([total[c].to_numpy() for c in columns], axis=1)


def _learned(rows: DataFrame, classes: np.ndarray, shards: int) -> Model:
    """A model from all rows, in shards of about SHARD_ROWS. One shard trains all epochs by itself; of several each
    trains an epoch at a time from the same model, which then moves by the mean of their moves, for a word by that of the
    shards that have it."""
    def count(texts: list[np.ndarray], labels: np.ndarray) -> dict:
        counts = _counted(texts, labels)
        at = np.flatnonzero(counts.any(axis=0))
        return {"place": at, "n0": counts[0, at], "n1": counts[1, at]}

    at, sums = _summed(rows.mapInArrow(_by_shard(count), "place bigint, n0 bigint, n1 bigint"), ["n0", "n1"])
    counts = np.zeros((2, BUCKETS + 1), np.int64)
    counts[:, at] = sums.T
    model = _begun(counts, classes)
    names = [f"d{i}" for i in range(DIM)]
    for turn in range(EPOCHS if shards > 1 else 1):
        epochs = 1 if shards > 1 else EPOCHS

        def step(texts: list[np.ndarray], labels: np.ndarray) -> dict:
            own = deepcopy(model)  # a task may have several shards
            train(own, texts, labels, classes, 6 + turn, epochs)
            by = np.rint((_flat(own) - _flat(model)) * UNIT).astype(np.int64)
            at = np.union1d(np.flatnonzero(by.any(axis=1)), np.arange(BUCKETS + 1, len(by)))
            return {"place": at, "n": np.full(len(at), len(labels))} | {c: by[at, i] * len(labels) for i, c in enumerate(names)}

        at, sums = _summed(rows.mapInArrow(_by_shard(step), f"place bigint, n bigint, {', '.join(f'{c} bigint' for c in names)}"), ["n", *names])
        by = np.zeros_like(_flat(model))
        by[at] = sums[:, 1:] / UNIT / sums[:, :1]
        _moved(model, by)
    return model


def calibrate(model: Model, rows: DataFrame, least: int = 15) -> None:
    """Thresholds by language on all rows that gradients never saw.

    A language's threshold is the middle of the gap with the best F1; with fewer than `least`
    rows of a class it is that of all rows together, and with none of a class, zero. Logits are counted in bins, of
    which there are no more than logits differ, so the driver gets counts and no rows.
    """
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            offsets = batch["hashes"].offsets.to_numpy().astype(np.int64)
            hashes, starts = batch["hashes"].values.to_numpy()[offsets[0] : offsets[-1]], offsets - offsets[0]
            logits = np.clip(model.logits(hashes, starts).astype(np.float64), -100, 100)
            columns = [pa.array(languages(hashes, starts)), pa.array(np.rint(logits * BINS).astype(np.int64)), batch["label"]]
            yield pa.RecordBatch.from_arrays(columns, names=["spoken", "bin", "label"])

    binned = rows.select("label", "hashes").mapInArrow(place, "spoken bigint, bin bigint, label int")
    counts = binned.groupBy("spoken", "bin").agg(F.sum("label").alias("ones"), F.count(F.lit(1)).alias("n")).toArrow()
    spoken, bins, ones, n = (counts[c].to_numpy() for c in ("spoken", "bin", "ones", "n"))

    def threshold(of: np.ndarray) -> float | None:
        x, at = np.unique(-bins[of], return_inverse=True)  # the highest first
        hit, seen = (np.cumsum(np.bincount(at, weights=w[of], minlength=len(x))) for w in (ones, n))
        if not len(x) or min(hit[-1], seen[-1] - hit[-1]) < least:
            return None
        best = int((2 * hit / (seen + hit[-1])).argmax())
        return -(x[best] + x[best + 1]) / 2 / BINS if best + 1 < len(x) else -x[best] / BINS - 1.0

    everywhere = threshold(np.ones(len(n), bool))
    for i in range(len(FUNCTION_WORDS)):
        own = threshold(spoken == i)
        model.thresholds[i] = own if own is not None else everywhere or 0.0
    model.thresholds[-1] = everywhere or 0.0


def _sure(label: int) -> Model:
    """What is learned where all rows have one label."""
    model = _begun(np.zeros((2, BUCKETS + 1)), np.zeros(2))
    model.top[:] = 0
    model.bias = 4.0 if label else -4.0
    return model


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", label: str = "toxic") -> Model:
    """A model from all labelled rows but those held out.

    Labels other than 0 and 1, and null keys, are left aside. About one row in five calibrates, the others
    train. With no rows at all the model says no.
    """
    usable = labels.select(F.col(f"`{key}`").alias("key"), F.col(f"`{label}`").cast("int").alias("label")).where(
        F.col("key").isNotNull() & F.col("label").isin(0, 1) & ~held_out(F.col("key"))
    )
    given = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
    aside = F.pmod(F.xxhash64(F.lit("aside"), "key"), F.lit(5)) == 0
    shards = max(1, -(-usable.count() // SHARD_ROWS))
    # Keys and labels, 12 bytes a row, go to the tasks, so that texts without a label are not shuffled.
    # Stored shard by shard, in an order that depends on the rows alone, so that each turn of training reads it as it lies.
    joined = given.join(F.broadcast(usable), "key").select(
        "label", "key", aside.alias("aside"), F.pmod(F.xxhash64(F.lit("shard"), "key"), F.lit(shards)).alias("shard"),
        F.xxhash64(F.lit("train"), "key").alias("draw"), F.xxhash64("text").alias("t"), token_hashes(F.col("text")).alias("hashes"),
    )
    dealt = joined.repartition(shards, "shard").sortWithinPartitions("shard", "draw", "key", "t", "label")
    joined = written(dealt.select("label", "aside", "shard", "hashes"), "labelled")
    seen = {(r["aside"], r["label"]): r["n"] for r in joined.groupBy("aside", "label").agg(F.count(F.lit(1)).alias("n")).collect()}
    classes = np.array([seen.get((False, c), 0) for c in (0, 1)])
    training = joined.where(~F.col("aside"))
    if not classes.sum():
        classes, training = np.array([seen.get((True, c), 0) for c in (0, 1)]), joined
    if not classes.all():
        return _sure(int(classes[1] > 0))
    model = _learned(training.select("label", "shard", "hashes"), classes, shards)
    calibrate(model, joined.where("aside"))
    return model


def score_documents(docs: DataFrame, model: Model, carry: list[str] | None = None, text: str = "text") -> DataFrame:
    """`row` (the columns `carry`, by default all) with `score`, 0 to 1.

    Only the text has a say. Null and empty texts, and texts without a word, get the score of
    no evidence; a very long text is worked through in parts and its best places count.
    Equal texts have equal scores. An empty table stays empty. The model, about 9 MB
    whatever the input, is sent to the tasks; texts are not shuffled.
    """
    # Only hashes go to Python, a batch at a time; what is carried waits in Spark's own memory. Said not to be
    # deterministic, so that a filter on the score does not have it computed twice.
    @F.arrow_udf("double")
    def score(hashes: pa.Array) -> pa.Array:
        offsets = hashes.offsets.to_numpy().astype(np.int64)
        values = hashes.values.to_numpy()[offsets[0] : offsets[-1]]
        return pa.array(model.scores(values, offsets - offsets[0]) if len(hashes) else np.zeros(0), pa.float64())

    row = F.struct(*[F.col(f"`{c}`") for c in (carry or docs.columns)]).alias("row")
    return docs.select(row, score.asNondeterministic()(token_hashes(F.col(f"`{text}`"))).alias("score"))
