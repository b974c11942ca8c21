"""Packing documents into sequences: shortest pack first, over the histogram of lengths.

Documents become token ids and are cut into pieces of at most a sequence. How many pieces have each
length is all that packing looks at: lengths are placed longest first, each onto the
shortest pack that has room, for all packs of a pattern at once. The patterns then meet
the pieces by their rank within their length.
"""

from __future__ import annotations

import heapq
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridgale.llm.common import written

LENGTH = 4096
END_ID = 2
ID_BYTES = 2  # of a stored id; the vocabulary has 49,408
TOKENIZER = "word_bpe_49k.json"
BATCH_BYTES = 8 << 20
BROADCAST_ROWS = 500_000  # rows of three numbers that are sent to all tasks; more are shuffled
REMEMBERED = 200_000  # pieces of words whose ids a task keeps
# Plain words, and how the tokenizer cuts them before it merges: the same rules
# on the letters below U+0250. Whatever else a word holds goes to the tokenizer as it is.
PLAIN = re.compile("[!-~À-ÖØ-öø-ɏ]+")
CUTS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zÀ-ÖØ-öø-ɏ]+|[0-9]|[^a-z0-9À-ÖØ-öø-ɏ]+")

Pattern = tuple[tuple[tuple[int, int], ...], int]  # ((length, copies), ...), packs


def shortest_pack_first(histogram: dict[int, int], size: int = LENGTH) -> list[Pattern]:
    """Patterns of lengths and how many packs have each.

    A length goes one by one onto the shortest packs with room, a whole pattern at a time;
    where no pack has room, new ones are opened and filled with it. The work depends on the
    number of different lengths and patterns, not on the number of pieces.
    """
    open_packs: dict[int, list[Pattern]] = {}
    rooms: list[int] = []  # heap of the rooms in open_packs, negative
    done: list[Pattern] = []

    def put(pattern: tuple, packs: int, room: int) -> None:
        if room <= 0:
            done.append((pattern, packs))
        else:
            if room not in open_packs:
                open_packs[room] = []
                heapq.heappush(rooms, -room)
            open_packs[room].append((pattern, packs))

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        if not 0 < length <= size:
            raise ValueError(f"length {length} is not in 1 to {size}")
        while left > 0:
            while rooms and not open_packs.get(-rooms[0]):
                open_packs.pop(-heapq.heappop(rooms), None)
            if rooms and -rooms[0] >= length:
                room = -rooms[0]
                pattern, packs = open_packs[room].pop()
                if left < packs:
                    put(pattern, packs - left, room)
                    packs = left
                # More copies at once while the pack stays the shortest.
                others = room if open_packs[room] else max((-r for r in rooms[1:3]), default=0)
                copies = max(1, min(room // length, (room - others) // length, left // packs))
                put((*pattern, (length, copies)), packs, room - copies * length)
                left -= packs * copies
            else:
                each = size // length
                packs, rest = divmod(left, each)
                if packs:
                    put(((length, each),), packs, size - each * length)
                if rest:
                    put(((length, rest),), 1, size - rest * length)
                left = 0
    return done + [pattern for some in open_packs.values() for pattern in some]


def slots(patterns: list[Pattern]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first rank, end rank, copies, first sequence, offset) for each length of each pattern."""
    taken: dict[int, int] = {}
    out, sequence = [], 0
    for pattern, packs in patterns:
        offset = 0
        for length, copies in pattern:
            first = taken.get(length, 0)
            taken[length] = first + packs * copies
            out.append((length, first, taken[length], copies, sequence, offset))
            offset += length * copies
        sequence += packs
    return out


def _tokenizer(path: str):
    from tokenizers import Tokenizer

    if path == TOKENIZER:
        import public_tokenizers

        path = public_tokenizers.path(TOKENIZER)
    return Tokenizer.from_file(path)


def _piece(tokenizer, letters: dict[int, str], piece: str) -> bytes:
    mapped = piece.encode().decode("latin-1").translate(letters)
    return np.array([t.id for t in tokenizer.model.tokenize(mapped)], "<u4").tobytes()


class WordEncoder:
    """The ids of words, as little-endian 32-bit numbers.

    A plain word is lower-cased, cut and merged piece by piece, and pieces are remembered;
    that skips the tokenizer's general normalising. Tests hold both ways against each other.
    """

    def __init__(self, tokenizer):
        self.tokenizer, self.plain = tokenizer, self._is_known(tokenizer)
        visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in visible]
        self.letters = {b: chr(b) for b in visible} | {b: chr(256 + i) for i, b in enumerate(hidden)}
        # Made from the parts and not from the encoder, which would then hold itself and stay after its task.
        self.piece = lru_cache(REMEMBERED)(partial(_piece, tokenizer, self.letters))

    @staticmethod
    def _is_known(tokenizer) -> bool:
        """Whether the tokenizer is of the kind that the short way is made for."""
        parts = repr(tokenizer.normalizer), repr(tokenizer.pre_tokenizer)
        return all(k in parts[0] for k in ("NFC", "Lowercase")) and r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]" in parts[1]

    def word(self, word: str) -> bytes:
        low = word.lower()
        if self.plain and "<|" not in word and PLAIN.fullmatch(low):
            return b"".join(map(self.piece, CUTS.findall(low)))
        return np.array(self.tokenizer.encode(word, add_special_tokens=False).ids, "<u4").tobytes()


def token_ids(texts: pa.Array, encoder: WordEncoder, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all texts, each with `end_id` after it, and where each text ends.

    Blanks and line ends always part tokens, so each different word between them is encoded
    once and its ids are put in wherever it stands.
    """
    parts = pc.split_pattern(pc.replace_substring(pc.fill_null(texts, ""), "\n", " "), " ")
    coded = pc.dictionary_encode(parts.flatten())
    ends = np.cumsum(pc.list_value_length(parts).to_numpy())
    known = [encoder.word(w) if w else b"" for w in coded.dictionary.to_pylist()]
    known.append(np.array([end_id], "<u4").tobytes())
    count = np.fromiter(map(len, known), np.int64, len(known)) // 4
    ids = np.frombuffer(b"".join(known), "<u4")
    begin = np.cumsum(count) - count
    order = np.insert(coded.indices.to_numpy().astype(np.int32), ends, len(count) - 1)
    lengths = count[order]
    stops = np.cumsum(lengths)
    at = np.repeat((begin[order] - (stops - lengths)).astype(np.int32), lengths)
    at += np.arange(len(at), dtype=np.int32)
    return ids[at], stops[ends + np.arange(len(ends))]


def _places(lengths: np.ndarray, seen: np.ndarray) -> np.ndarray:
    """The place of each piece among those of its length, going on from the numbers `seen`."""
    order = np.argsort(lengths, kind="stable")
    ordered = lengths[order]
    out = np.empty(len(lengths), np.int64)
    out[order] = np.arange(len(ordered)) - np.searchsorted(ordered, ordered)
    out += seen[lengths]
    np.add.at(seen, lengths, 1)
    return out


def _cut(path: str, size: int, end_id: int, with_ids: bool, id_bytes: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = WordEncoder(_tokenizer(path))
        task, seen = TaskContext.get().partitionId(), np.zeros(size + 1, np.int64)
        for whole in batches:
            weight = np.cumsum(pc.fill_null(pc.binary_length(whole["text"]), 0).to_numpy())
            cuts = np.searchsorted(weight, np.arange(BATCH_BYTES, int(weight[-1]) if len(weight) else 0, BATCH_BYTES))
            for a, b in zip([0, *cuts], [*cuts, len(whole)]):
                if a == b:
                    continue
                batch = whole.slice(a, b - a)
                ids, ends = token_ids(batch["text"], encoder, end_id)
                begins = np.concatenate([[0], ends[:-1]])
                tokens = ends - begins
                pieces = -(-tokens // size)
                of = np.repeat(np.arange(len(batch)), pieces)
                start = (np.arange(len(of)) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * size
                length = np.minimum(size, tokens[of] - start)
                at = begins[of] + start
                bounds = list(zip(at.tolist(), (at + length).tolist()))
                columns = {
                    "row": batch["row"].take(pa.array(of)),
                    "start": pa.array(start), "length": pa.array(length),
                    "ids_crc32": pa.array([zlib.crc32(ids[x:y]) for x, y in bounds], pa.int64()),
                    "doc_tokens": pa.array(tokens[of]), "task": pa.array(np.full(len(of), task, np.int32)),
                    "place": pa.array(_places(length, seen)),
                }
                if with_ids:
                    if len(ids) and int(ids.max()) >> (8 * id_bytes):
                        raise ValueError(f"an id does not fit into {id_bytes} bytes")
                    offsets = np.concatenate([[0], np.cumsum(length)]) * id_bytes
                    short = pa.py_buffer(ids.astype(f"<u{id_bytes}"))
                    columns["ids"] = pa.Array.from_buffers(pa.binary(), len(length), [None, pa.py_buffer(offsets.astype(np.int32)), short])
                yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    return cut


def pack_documents(
    docs: DataFrame, carry: list[str] | None = None, text: str = "text", size: int = LENGTH,
    tokenizer: str = TOKENIZER, end_id: int = END_ID, with_ids: bool = True, id_bytes: int = ID_BYTES,
) -> DataFrame:
    """`row` (the columns `carry`, by default all) with `start`, `length`, `ids_crc32`, `doc_tokens`,
    `sequence_id`, `offset`, and with `with_ids` the token `ids`, little-endian numbers of `id_bytes` bytes; one
    row a piece.

    A null or empty text is its end id alone. A very long text is cut into whole
    sequences and a rest. Rows that repeat are packed each. An empty table gives no piece.
    Pieces are written once; the histogram has at most `size` rows, whatever the input, and
    so bounds what the driver packs and what is sent to the tasks. A length may have any
    share of the pieces: a piece is numbered by the task that cuts it, and a task's numbers of a length go on
    from those of the tasks before it. These are a row for each task and length; while they are few, ids go
    from the written pieces to the result without a shuffle, and beyond that in one.
    """
    body = F.col(f"`{text}`").alias("text")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in (carry or docs.columns)]).alias("row"), body)
    kind = rows.schema["row"].dataType.simpleString()
    schema = f"row {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, task int, place bigint" + ", ids binary" * with_ids
    pieces = written(rows.mapInArrow(_cut(tokenizer, size, end_id, with_ids, id_bytes), schema), "pieces")
    of_task = written(pieces.groupBy("task", "length").agg(F.count("*").alias("n")), "piece-counts")
    histogram = {r["length"]: r["n"] for r in of_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    places = docs.sparkSession.createDataFrame(
        slots(shortest_pack_first(histogram, size)),
        "_length bigint, _first bigint, _end bigint, _copies bigint, _sequence bigint, _offset bigint",
    )
    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    begins = of_task.select("task", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("_before"))
    if of_task.count() <= BROADCAST_ROWS:
        begins = F.broadcast(begins)
    numbered = pieces.join(begins, ["task", "length"]).withColumn("_rank", F.col("_before") + F.col("place"))
    met = numbered.join(
        F.broadcast(places),
        (F.col("length") == F.col("_length")) & (F.col("_rank") >= F.col("_first")) & (F.col("_rank") < F.col("_end")),
    )
    past = F.col("_rank") - F.col("_first")
    return met.select(
        "row", "start", "length", "ids_crc32", "doc_tokens",
        (F.col("_sequence") + F.call_function("div", past, F.col("_copies"))).alias("sequence_id"),
        (F.col("_offset") + (past % F.col("_copies")) * F.col("length")).alias("offset"),
        *(["ids"] if with_ids else []),
    )
