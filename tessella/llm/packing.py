"""Packing token sequences: sum-of-squares placement with a fixed number of tokens per sequence."""

from __future__ import annotations

import json
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessella.llm.common import cut

CAPACITY, END_ID = 4096, 1
#: Pieces that one task packs on average; leftover bins are some dozens a task.
SHARD_PIECES = 32_768
#: Spellings whose ids a worker remembers. More only costs time.
REMEMBERED = 300_000


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


#: The steps before the model of the one tokenizer that `Encoder` has a short way for.
STEPS = {
    "normalizer": {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {
        "type": "Sequence",
        "pretokenizers": [
            {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True},
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
    "model": {"type": "BPE", "dropout": None, "continuing_subword_prefix": None, "end_of_word_suffix": "</w>", "byte_fallback": False, "ignore_merges": False},
}


def has_short_way(path: str) -> bool:
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model = {k: v for k, v in spec["model"].items() if k in STEPS["model"]}
    return spec["normalizer"] == STEPS["normalizer"] and spec["pre_tokenizer"] == STEPS["pre_tokenizer"] and model == STEPS["model"]


class Encoder:
    """Ids of whole texts, as little-endian 32-bit integers.

    A tokenizer with other steps than STEPS encodes whole texts itself. With these, the tokenizer lowers letters, splits at white space and takes a full stop or comma apart from a letter or digit before
    it, so each run between these is encoded once and remembered (in lower case, for Latin texts). Runs of 64 characters
    or more aren't remembered, nor what hasn't been used since the store last filled up.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer, self.known, self.older = Tokenizer.from_file(path), {}, {}
        self.short = has_short_way(path)
        self.beyond = re.compile("[^\x00-\u017e]")
        self.marks = re.compile(r"(?:[^\w\s]|[_\x1c-\x1f])[.,](?:[ \n]|$)")
        self.apart = re.compile(r"(.*?)((?:[^\w\s']|_){0,8})", re.DOTALL)
        # the byte-level alphabet: printable bytes stand for themselves, the rest for U+0100 and on
        plain = {b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174}
        self.alphabet = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in plain)}

    def __call__(self, text: str) -> bytes:
        if not self.short:
            return self._ids([text])[0]
        latin = not self.beyond.search(text)
        if latin:
            text = text.lower()
        text = text.replace("\n", " ")
        if latin and not self.marks.search(text):
            text = text.replace(". ", " . ").replace(", ", " , ")
        runs = text.split(" ")
        if missing := set(runs).difference(self.known):
            self._learn(missing, latin)
        out = b"".join(map(self.known.__getitem__, runs))
        for r in missing:
            if len(r) >= 64:
                del self.known[r]
        if len(self.known) > REMEMBERED:
            self.known, self.older = {}, self.known
        return out

    def _learn(self, runs: set[str], latin: bool) -> None:
        """A run of Latin letters is one word of the tokenizer's, which its model takes at once."""
        known, rest, tokenize = self.known, [], self.tokenizer.model.tokenize
        for r in runs:
            if (ids := self.older.get(r)) is not None:
                known[r] = ids
                continue
            word, marks = (r, "") if r.isalpha() else self.apart.fullmatch(r).groups()
            if latin and word.isalpha():
                ids = array("I", [t.id for t in tokenize(word if word.isascii() else word.encode().decode("latin-1").translate(self.alphabet))]).tobytes()
                if marks and marks not in known:
                    known[marks] = self._ids([marks])[0]
                known[r] = ids + known[marks] if marks else ids
            else:
                rest.append(r)
        known.update(zip(rest, self._ids(rest), strict=True))

    def _ids(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, dtype="<u4").tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


PIECE_FIELDS = (("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()))


def _cutter(path: str, capacity: int, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encode, end = Encoder(path), np.array([end_id], dtype="<u4").tobytes()
        for batch in batches:
            rows = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = encode(text.as_py() or "") + end
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    rows.append((doc, piece, at // 4, len(part) // 4, zlib.crc32(part)))
            cols = list(zip(*rows, strict=True)) or [[]] * len(PIECE_FIELDS)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(cols, PIECE_FIELDS, strict=True)], names=[n for n, _ in PIECE_FIELDS])

    return run


def sum_of_squares(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each item, in the order given.

    With N(g) open bins of residual gap g, an item of length s goes to the open bin where sum N(g)^2 becomes smallest: a
    bin of gap g changes it by 2 N(g-s) - 2 N(g) + 2, or by 1 - 2 N(g) if the item fills it. Ties go to the fullest bin.
    A bin is opened where none has room: with the longest items first, opening one sooner only costs bins.
    """
    n = np.zeros(capacity + 1, dtype=np.int64)
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    bins, offsets, used = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64), 0
    for i, s in enumerate(lengths.tolist()):
        if s >= capacity:
            bins[i], offsets[i], used = used, 0, used + 1
            continue
        have = n[s:capacity]
        change = 2 * n[: capacity - s] - 2 * have + 2
        change[0] = 1 - 2 * have[0]
        change[have == 0] = 1 << 60
        at = int(change.argmin()) if len(change) else 0
        gap = at + s
        if len(change) and have[at]:
            b = open_bins[gap].pop()
            n[gap] -= 1
        else:
            b, gap, used = used, capacity, used + 1
        bins[i], offsets[i] = b, capacity - gap
        if gap > s:
            open_bins[gap - s].append(b)
            n[gap - s] += 1
    return bins, offsets


def _packer(capacity: int):
    def run(table: pa.Table) -> pa.Table:
        length, shard = table.column("length").to_numpy(), table.column("_shard").to_numpy()
        # longest first; then by document, so that a rerun gives the same
        order = np.lexsort((table.column("piece").to_numpy(), table.column("ids_crc32").to_numpy(), table.column("doc_id").fill_null(-1).to_numpy(), -length))
        table, length = table.take(pa.array(order)), length[order]
        bins, offsets = sum_of_squares(length, capacity)
        return table.drop_columns(["_shard"]).append_column("sequence_id", pa.array((shard << 32) + bins)).append_column("offset", pa.array(offsets))

    return run


def pack(docs: DataFrame, capacity: int = CAPACITY, end_id: int = END_ID, tokenizer: str | None = None, shard_pieces: int = SHARD_PIECES) -> DataFrame:
    """Pack docs (doc_id, text) into sequences of at most `capacity` tokens: one row a piece, with its place.

    Texts become ids plus `end_id`; only documents longer than a sequence are cut. Pieces are dealt by hash (of the piece
    and its place in the materialised table, so that repeated rows are spread as well) to shards of about `shard_pieces`, so that the number of shards grows with the input and a task's memory doesn't, and each shard
    is packed by sum of squares, longest pieces first.

    Ties in length go by document and piece. Null or empty text: the end id alone. Null id: kept, null. Repeated rows are packed as often as they occur. An empty
    table gives an empty table.
    """
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long"
    pieces = cut(narrow.mapInArrow(_cutter(tokenizer or default_tokenizer(), capacity, end_id), schema))
    shards = -(-pieces.count() // shard_pieces)
    dealt = pieces.withColumn("_shard", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", F.monotonically_increasing_id()), F.lit(max(1, shards))))
    return dealt.groupBy("_shard").applyInArrow(_packer(capacity), f"{schema}, sequence_id long, offset long")


def op5_packing(docs: DataFrame) -> DataFrame:
    return pack(docs)
