"""Lexical retrieval packing: windows of related documents from a sharded BM25 index.

Documents become token ids, each with an end id.  The token table is cut into
shards of consecutive documents; each shard has an inverted index over its
documents' token ids, weighted by BM25 with document frequencies and mean length
of the whole corpus.  A seed document opens a window; its nearest unused
neighbours fill it, and the last one is cut where the window ends and becomes
the next seed.  Only the last window of a shard holds padding.
A seed asks with all its distinct ids, and finds documents of its own shard alone.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from array import array

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from crease.llm.text import hash_words, keep_in_worker, pieces, text_buffer, word_bounds
from crease.session import scratch_path

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
WINDOW = 2048
END_ID = 1
SHARD_DOCS = 2048           # documents of one inverted index
SHARD_IDS = 1 << 22         # ids after which a shard ends
COMMON = 8                  # ids in at least a COMMON-th of a shard's documents have their weights held densely
K1, B = 1.2, 0.75
CACHE = 1_000_000           # words whose ids a worker remembers (some 25 bytes each)
PARTS = 60_000              # pieces of words whose ids a worker remembers (some 200 bytes each)
PIECE_BYTES = 2 << 20       # text that is encoded at once

# the tokenizer's word pattern for words of printable Latin-1 characters, where case
# folding and normal form are character by character
_LETTER, _DIGIT = "a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff", "0-9\xb2\xb3\xb9\xbc-\xbe"
_WORD = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTER}]+|[{_DIGIT}]|[^{_LETTER}{_DIGIT}]+")
_PLAIN = re.compile("[\x21-\x7e\xa1-\xff]*")


def _byte_letters() -> dict[int, str]:
    """The public byte-level alphabet: printable bytes stand for themselves, the
    others, in order, for the code points from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(own)]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


_LETTERS = _byte_letters()


class Encoder:
    """Texts -> ids as the tokenizer gives them, with the ids of words remembered.

    The tokenizer drops white space and never joins what it separates, so the ids of
    a word (a run without white space) depend on the word alone.  Words are looked
    up by 64-bit hash, once per batch and distinct word; unseen ones are split by
    the tokenizer's pattern and go to its model, or, beyond printable Latin-1 or
    with a special token's brackets, to the whole tokenizer.  Words with such brackets
    are told apart by case, as the tokenizer does for special tokens alone.
    """

    def __init__(self, path: str):
        self.path = path
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self._forget()

    def _forget(self) -> None:
        self.keys = np.zeros(0, np.uint64)       # word hashes in order, and the slot of each
        self.slot = np.zeros(0, np.int32)
        self.part: dict[str, bytes] = {}         # piece of a word -> ids
        self.at = np.zeros(0, np.int32)          # by slot: where its ids begin, and how many
        self.size = np.zeros(0, np.int32)
        self.pool = np.zeros(0, np.uint16)

    def word(self, text: str) -> bytes:
        """Ids of a word as 16-bit numbers."""
        if "<|" in text or not _PLAIN.fullmatch(text):
            return array("H", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        return b"".join(map(self.piece, _WORD.findall(text.lower())))

    def piece(self, w: str) -> bytes:
        ids = self.part.get(w)
        if ids is None:
            if len(self.part) >= PARTS:
                self.part.clear()
            spelt = w if w.isascii() else w.encode().decode("latin-1").translate(_LETTERS)
            ids = array("H", [t.id for t in self.model.tokenize(spelt)]).tobytes()
            if len(w) <= 64:                     # so the pieces' bytes are bounded too
                self.part[w] = ids
        return ids

    @staticmethod
    def _keys(raw: np.ndarray, offsets: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hash of every word, blind to case but in words that hold ``<|``."""
        keys = hash_words(raw, starts, ends)
        text = raw[int(offsets[0]):int(offsets[-1])]
        brackets = np.flatnonzero((text[:-1] == 60) & (text[1:] == 124)) + int(offsets[0])
        for w in np.unique(np.searchsorted(starts, brackets, side="right") - 1).tolist():
            spelt = raw[starts[w]:ends[w]].tobytes()
            keys[w] = int.from_bytes(hashlib.blake2b(spelt, digest_size=8).digest(), "little")
        return keys

    def _find(self, hashes: np.ndarray) -> np.ndarray:
        """Slot of every hash, -1 where the word is unseen."""
        if not len(self.keys):
            return np.full(len(hashes), -1, np.int64)
        at = np.minimum(np.searchsorted(self.keys, hashes), len(self.keys) - 1)
        return np.where(self.keys[at] == hashes, self.slot[at], np.int32(-1)).astype(np.int64)

    def _learn(self, keys: np.ndarray, words: list[str]) -> None:
        """Remember words by their hashes, which are sorted and unseen."""
        lists = list(map(self.word, words))
        size = np.fromiter(map(len, lists), dtype=np.int64, count=len(lists)) // 2
        flat = np.frombuffer(b"".join(lists), dtype=np.uint16)
        at = np.searchsorted(self.keys, keys)
        self.slot = np.insert(self.slot, at, np.arange(len(self.at), len(self.at) + len(keys), dtype=np.int32))
        self.keys = np.insert(self.keys, at, keys)
        self.at = np.concatenate([self.at, (len(self.pool) + np.cumsum(size) - size).astype(np.int32)])
        self.size = np.concatenate([self.size, size.astype(np.int32)])
        self.pool = np.concatenate([self.pool, flat])

    def encode(self, column: pa.Array) -> list[np.ndarray]:
        """Ids (uint16) of each text of a string column; null: none."""
        raw, offsets = text_buffer(column)
        starts, ends = word_bounds(raw, offsets)
        hashes, first, back = np.unique(self._keys(raw, offsets, starts, ends), return_index=True, return_inverse=True)
        if len(self.keys) + len(hashes) > CACHE or len(self.pool) > 8 * CACHE:
            self._forget()
        slots = self._find(hashes)
        new = np.flatnonzero(slots < 0)
        if len(new):
            slots[new] = np.arange(len(self.at), len(self.at) + len(new))
            lo, text = int(offsets[0]), raw[int(offsets[0]):int(offsets[-1])].tobytes()
            spans = zip((starts[first[new]] - lo).tolist(), (ends[first[new]] - lo).tolist(), strict=True)
            self._learn(hashes[new], [text[a:b].decode() for a, b in spans])
        slots = slots[back]
        sizes = self.size[slots].astype(np.int64)
        stop = np.cumsum(sizes)
        ids = self.pool[np.arange(len(sizes) and stop[-1]) + np.repeat(self.at[slots] - stop + sizes, sizes)]
        cuts = np.append(0, stop)[np.searchsorted(starts, offsets)]
        return [ids[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def tokenize(docs: DataFrame, tokenizer: str = TOKENIZER, id_col: str = "doc_id", text_col: str = "text") -> str:
    """Write ``kind=0`` rows (doc_id, ids as little-endian 16-bit numbers, the end id
    last) and ``kind=1`` rows (ids: how many of a task's documents hold each id) and
    return the folder, which lies in the shared checkpoint folder."""
    def run(batches):
        encoder = keep_in_worker(("packing", tokenizer), lambda: Encoder(tokenizer))
        df, docs_seen, ids_seen = np.zeros(1 << 16, np.int64), 0, 0
        for b in batches:
            for part in pieces(b, PIECE_BYTES):
                out = []
                for ids in encoder.encode(part.column(1)):
                    ids = np.append(ids, np.uint16(END_ID))
                    out.append(ids.tobytes())
                    ids = np.sort(ids, kind="stable")
                    df[ids[np.append(True, ids[1:] != ids[:-1])]] += 1
                    ids_seen += len(ids)
                docs_seen += part.num_rows
                yield pa.RecordBatch.from_arrays([pa.array(np.zeros(part.num_rows, np.int32)), part.column(0), pa.array(out, pa.binary())],
                                                 names=["kind", "doc_id", "ids"])
        if docs_seen:
            yield pa.RecordBatch.from_arrays([pa.array([1], pa.int32()), pa.array([None], pa.int64()), pa.array(
                [np.concatenate([df, [docs_seen, ids_seen]]).astype("<i8").tobytes()], pa.binary())], names=["kind", "doc_id", "ids"])

    path = scratch_path(docs.sparkSession, "tokens")
    (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
     .mapInArrow(run, "kind int, doc_id long, ids binary")
     .write.partitionBy("kind").option("compression", "zstd").parquet(path))
    return path


def _statistics(counts: DataFrame) -> np.ndarray:
    """Documents with each id, then the numbers of documents and of ids, over the whole corpus.

    The vocabulary bounds the result (65,538 numbers), however large the corpus.
    """
    size = (1 << 16) + 2

    def add(batches):
        total = np.zeros(size, np.int64)
        for b in batches:
            for x in b.column(0).to_pylist():
                total += np.frombuffer(x, dtype="<i8")
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["i", "n"])

    out = np.zeros(size, np.int64)
    for r in counts.select("ids").mapInArrow(add, "i long, n long").groupBy("i").agg(F.sum("n").alias("n")).collect():
        out[r["i"]] = r["n"]
    return out


class Shard:
    """Inverted index over the ids of some documents, and the packing of their windows."""

    def __init__(self, ids: list[np.ndarray], idf: np.ndarray, mean: float):
        self.ids, self.idf = ids, idf
        terms, freq, sizes = [], [], []
        for x in ids:
            x = np.sort(x, kind="stable")
            at = np.flatnonzero(np.append(True, x[1:] != x[:-1]))
            terms.append(x[at])
            freq.append(np.diff(np.append(at, len(x))))
            sizes.append(len(at))
        self.terms = terms
        term = np.concatenate(terms)
        doc = np.repeat(np.arange(len(ids)), sizes)
        tf = np.concatenate(freq).astype(np.float64)
        length = np.fromiter(map(len, ids), dtype=np.float64, count=len(ids))[doc]
        weight = idf[term] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * length / mean))
        order = np.argsort(term, kind="stable")
        self.doc, self.weight = doc[order].astype(np.int32), weight[order].astype(np.float32)
        self.at = np.searchsorted(term[order], np.arange(1 << 16 | 1, dtype=np.int64))
        # at most 4 * COMMON bytes for each document and distinct id of it
        count = np.diff(self.at)
        common = np.flatnonzero(count * COMMON >= max(COMMON, len(ids)))
        self.row = np.full(1 << 16, -1, np.int32)
        self.row[common] = np.arange(len(common))
        self.dense = np.zeros((len(common), len(ids)), np.float32)
        held = np.repeat(self.row, count)
        self.dense[held[held >= 0], self.doc[held >= 0]] = self.weight[held >= 0]
        self.free = np.ones(len(ids), dtype=bool)
        self.next = 0

    def scores(self, seed: int) -> np.ndarray:
        """BM25 of every document of the shard for all distinct ids of the seed."""
        terms = self.terms[seed]
        row = self.row[terms]
        score = self.dense[row[row >= 0]].sum(axis=0, dtype=np.float64)
        rare = terms[row < 0].astype(np.int64)
        size = self.at[rare + 1] - self.at[rare]
        stop = np.cumsum(size)
        at = np.arange(len(size) and stop[-1]) + np.repeat(self.at[rare] - stop + size, size)
        return score + np.bincount(self.doc[at], self.weight[at], len(self.ids))

    def neighbours(self, seed: int) -> np.ndarray:
        """The best 64 unused documents by BM25, best first (ties: the earlier)."""
        score = self.scores(seed)
        score[~self.free] = 0
        some = np.flatnonzero(score > 0)
        if len(some) > 64:
            some = np.sort(some[np.argpartition(-score[some], 63)[:64]])
        return some[np.argsort(-score[some], kind="stable")]

    def pack(self, window: int) -> list[tuple[int, int, int, int, int]]:
        """(document, start, length, window number, offset) of every piece."""
        out, seq, fill = [], 0, 0
        seed, queue = None, []
        while True:
            doc = next((d for d in queue if self.free[d]), None)
            if doc is None:
                if seed is not None and fill and queue is not None and len(queue):
                    queue = self.neighbours(seed)
                    doc = next((d for d in queue if self.free[d]), None)
                if doc is None:
                    while self.next < len(self.ids) and not self.free[self.next]:
                        self.next += 1
                    if self.next == len(self.ids):
                        return out
                    doc = self.next
            self.free[doc] = False
            at, n = 0, len(self.ids[doc])
            opened = fill == 0
            while at < n:
                take = min(n - at, window - fill)
                out.append((int(doc), at, take, seq, fill))
                at, fill = at + take, fill + take
                if fill == window:
                    seq, fill, opened = seq + 1, 0, True
            # the document that began the open window asks for the rest of it
            if opened or seed is None or len(queue) == 0:
                seed = doc
                queue = self.neighbours(seed) if fill else []


def pack(docs: DataFrame, window: int = WINDOW, tokenizer: str = TOKENIZER, id_col: str = "doc_id",
         text_col: str = "text", with_ids: bool = True) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id,
    offset`` and, ``with_ids``, ``ids`` (little-endian unsigned 32-bit numbers).

    Every id of every document, its end id included, lies in exactly one piece.
    Null and empty texts are the end id alone.  Repeated rows are packed each for
    itself; a null doc_id stays null.  No rows: no rows.

    Shards are consecutive documents of the token table, so nothing is shuffled and
    no task holds more than a shard (``SHARD_DOCS`` documents or ``SHARD_IDS`` ids and
    one document).
    """
    path = tokenize(docs, tokenizer, id_col, text_col)
    spark = docs.sparkSession
    table = spark.read.schema("doc_id long, ids binary, kind int").parquet(path)
    stats = _statistics(table.where("kind = 1"))
    n, ids_all = int(stats[-2]), int(stats[-1])
    idf = np.log1p((n - stats[:-2] + 0.5) / (stats[:-2] + 0.5))
    mean = max(1.0, ids_all / max(1, n))
    shipped = spark.sparkContext.broadcast(idf)            # 65,536 numbers

    def run(batches):
        from pyspark import TaskContext

        part, sequences = TaskContext.get().partitionId(), 0

        def flush(names, ids):
            nonlocal sequences
            shard = Shard(ids, shipped.value, mean)
            pieces = shard.pack(window)
            at = [ids[d][s:s + k].astype("<u4").tobytes() for d, s, k, _, _ in pieces]
            doc, start, length, seq, offset = (np.array(c, dtype=np.int64) for c in zip(*pieces, strict=True))
            first = (part << 33) + sequences
            sequences += int(seq[-1]) + 1
            total = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids))
            columns = {"doc_id": pa.array(names, pa.int64()).take(pa.array(doc)), "start": pa.array(start),
                       "length": pa.array(length), "ids_crc32": pa.array([zlib.crc32(x) for x in at], pa.int64()),
                       "doc_tokens": pa.array(total[doc]), "sequence_id": pa.array(seq + first), "offset": pa.array(offset)}
            if with_ids:
                columns["ids"] = pa.array(at, pa.binary())
            yield pa.RecordBatch.from_pydict(columns)

        names, ids, held = [], [], 0
        for b in batches:
            for d, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                names.append(d)
                ids.append(np.frombuffer(x, dtype=np.uint16))
                held += len(ids[-1])
                if len(ids) >= SHARD_DOCS or held >= SHARD_IDS:
                    yield from flush(names, ids)
                    names, ids, held = [], [], 0
        if ids:
            yield from flush(names, ids)

    return table.where("kind = 0").select("doc_id", "ids").mapInArrow(
        run, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
        + ", ids binary" * with_ids)
