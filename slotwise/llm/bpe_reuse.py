"""Operator 7: byte-level BPE with content-defined chunks encoded once.

A rolling hash over the bytes of a text cuts it into chunks, so equal passages
fall into equal chunks wherever they stand. Chunks are counted by hash; those
that two or more documents hold are the shared ones. Documents without a shared
chunk are encoded where they are read. For the others, every shared chunk is
encoded once, in a task of its hash, unshared stretches are encoded in place,
and a document's parts meet again, as ids, to be joined.

A cut may fall inside a token. A join is repaired by decoding tokens on both
sides of it and encoding that text again; the window grows until the new ids
agree with the old ones at both of its ends beyond a place where the tokenizer
always parts, a visible ASCII character before a space or line break. Splitting looks
at most one character past such a place, so the agreement is exact.

The set of shared chunks is passed on as a bitmap of ``filter_bits`` bits. It
may let an unshared chunk through, which is then encoded as if shared; it can
miss none. So the broadcast is bounded, and only texts of shared chunks and ids
of documents that hold any are shuffled.

Defined cases: a null or empty text has no ids and decodes to an empty text;
repeated rows each give their row; a special token's string in a text is that
token, as in the library. Columns other than doc_id and text are never read.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotwise.llm import bitmap
from slotwise.llm.common import ship, written

FILTER_BITS = 1 << 26
MEAN_CHUNK = 512  #: bytes, a power of two
WINDOW = 16  #: bytes under the rolling hash

_GEAR = np.random.default_rng(7).integers(0, 2**32, 256, dtype=np.uint32)


def cuts(data: bytes, mean: int = MEAN_CHUNK) -> list[int]:
    """Ends of the chunks of ``data``, which must be UTF-8; characters stay whole.

    The hash of a place covers the ``WINDOW`` bytes before it: doubling sums
    two windows, one shifted, so a few vector operations serve all places.
    """
    n = len(data)
    if n <= WINDOW:
        return [n] if n else []
    b = np.frombuffer(data, np.uint8)
    h = _GEAR[b]
    width = 1
    while width < WINDOW:
        h[width:] = h[width:] + (h[:-width] << np.uint32(width))
        width *= 2
    ends = np.flatnonzero((h[:-1] >> np.uint32(8)) & np.uint32(mean - 1) == 0) + 1
    ends = ends[(ends >= WINDOW) & ((b[np.minimum(ends, n - 1)] & 0xC0) != 0x80)]
    return [*ends.tolist(), n]


def chunks(data: bytes, mean: int = MEAN_CHUNK) -> list[bytes]:
    out, start = [], 0
    for end in cuts(data, mean):
        if end > start:
            out.append(data[start:end])
            start = end
    return out


def key(chunk: bytes) -> bytes:
    return hashlib.blake2b(chunk, digest_size=16).digest()


def _short(k: bytes) -> int:
    return int.from_bytes(k[:8], "little", signed=True)


#: Characters without, or of, white space beyond which the library's encoder,
#: whose time does not grow with the square of a run, is used.
LONG_RUN = 1000
_SPACES = re.compile(r"\s{%d}" % LONG_RUN)


def longest_run(text: str) -> int:
    return LONG_RUN + 1 if _SPACES.search(text) else max(map(len, text.split()), default=0)


class Codec:
    """Encodes and decodes with a byte-level BPE file of the tokenizers library."""

    def __init__(self, path: str, ranks: str | None = None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        with open(path) as f:
            spec = json.load(f)
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.fast = self._ranked(ranks) if ranks else None
        self.library = self._library(path)
        shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
        symbol = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(x for x in range(256) if x not in set(shown))}
        vocab = {i: bytes(symbol[c] for c in t) for t, i in spec["model"]["vocab"].items() if t not in self.special}
        vocab |= {i: t.encode() for t, i in self.special.items()}
        self.token = [vocab.get(i, b"") for i in range(max(vocab) + 1)]
        # The tokenizer always parts after a visible ASCII character, before a
        # space or line break.
        self.closes = [t != b"" and 32 < t[-1] < 127 for t in self.token]
        self.opens = [t[:1] in (b" ", b"\n") for t in self.token]

    @staticmethod
    def _library(path: str):
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        return tokenizer

    def _ranked(self, ranks: str):
        """The same vocabulary as a rank file, which encodes faster."""
        import base64

        import public_tokenizers
        import tiktoken

        with open(ranks, "rb") as f:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens=self.special)

    def encode(self, text: str) -> np.ndarray:
        if self.fast is not None and (len(text) <= LONG_RUN or longest_run(text) <= LONG_RUN):
            return self.fast.encode_to_numpy(text, allowed_special="all")
        return np.array(self.library.encode(text, add_special_tokens=False).ids, dtype=np.uint32)

    def raw(self, ids) -> bytes:
        return b"".join(map(self.token.__getitem__, ids if isinstance(ids, list) else ids.tolist()))

    def decode(self, ids) -> str:
        return self.raw(ids).decode("utf-8", "replace")


_CODECS: dict[tuple, Codec] = {}


def codec(path: str, ranks: str | None) -> Codec:
    if (path, ranks) not in _CODECS:
        _CODECS[path, ranks] = Codec(path, ranks)
    return _CODECS[path, ranks]


def _anchor(codec: Codec, ids: list[int], order: range) -> int | None:
    """The first i of ``order`` such that ids[:i] and ids[i:] always part."""
    closes, opens = codec.closes, codec.opens
    for i in order:
        if closes[ids[i - 1]] and opens[ids[i]]:
            return i
    return None


def _inside(token: bytes) -> bool:
    """Whether a token starts inside a character."""
    return token[:1] != b"" and token[0] & 0xC0 == 0x80


def join(codec: Codec, left: list[int], right: list[int], window: int = 16) -> list[int]:
    """Ids of the joined texts from the ids of two neighbours."""
    if not left or not right:
        return left + right
    while True:
        a, b = max(0, len(left) - window), min(len(right), window)
        while a and _inside(codec.token[left[a]]):
            a -= 1
        while b < len(right) and _inside(codec.token[right[b]]):
            b += 1
        before, after = left[a:], right[:b]
        new = codec.encode(codec.raw(before + after).decode("utf-8")).tolist()
        # From the edges inwards: up to the first sure parting the ids must
        # agree; without one the window must reach the text's end.
        head = 0 if a == 0 else _anchor(codec, before, range(1, len(before)))
        tail = b if b == len(right) else _anchor(codec, after, range(b - 1, 0, -1))
        if head is not None and tail is not None:
            kept = b - tail
            if new[:head] == before[:head] and (kept == 0 or new[-kept:] == after[tail:]):
                return left[:a] + new + right[b:]
        if a == 0 and b == len(right):
            return new
        window *= 4


def join_all(codec: Codec, parts: list[list[int]]) -> list[int]:
    """All parts in order; settled ids are set aside so that long texts stay linear."""
    done: list[int] = []
    open_: list[int] = []
    for part in parts:
        # Only the end of what is joined so far can change: back to a sure parting.
        at = len(open_) - 64
        cut = _anchor(codec, open_, range(at, 0, -1)) if at > 0 else None
        if cut:
            done += open_[:cut]
            open_ = open_[cut:]
        open_ = join(codec, open_, part)
    return done + open_


_ZSTD: list = []


def _zstd():
    if not _ZSTD:
        import zstandard

        _ZSTD.extend([zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()])
    return _ZSTD


def _packed(ids: np.ndarray) -> bytes:
    return _zstd()[0].compress(ids.astype("<u4" if len(ids) and ids.max() > 0xFFFF else "<u2").tobytes())


def _unpacked(blob: bytes, wide: bool) -> list[int]:
    return np.frombuffer(_zstd()[1].decompress(blob), "<u4" if wide else "<u2").tolist()


DIGEST = "n_tokens long, ids_sha256 string, decoded_sha256 string"


def _digest(codec: Codec, ids: np.ndarray) -> tuple:
    return len(ids), hashlib.sha256(np.asarray(ids, dtype="<u4").tobytes()).hexdigest(), hashlib.sha256(codec.decode(ids).encode()).hexdigest()


def shared_filter(docs: DataFrame, bits: int = FILTER_BITS, mean: int = MEAN_CHUNK) -> np.ndarray:
    """Bitmap (bytes) of the hashes of chunks that stand twice or more in the corpus."""
    ship(docs.sparkSession)

    def hashes(batches: Iterator) -> Iterator:
        import pandas as pd

        for batch in batches:
            seen: dict[int, int] = {}
            for text in batch["text"]:
                for c in chunks((text or "").encode(), mean):
                    h = _short(key(c))
                    seen[h] = seen.get(h, 0) + 1
            yield pd.DataFrame({"h": list(seen.keys()), "n": list(seen.values())})

    counts = docs.select("text").mapInPandas(hashes, "h long, n long").groupBy("h").agg(F.sum("n").alias("n")).where("n > 1")
    return bitmap.collect(counts, bits)


def encode(docs: DataFrame, tokenizer: str, ranks: str | None = None, bits: int = FILTER_BITS, mean: int = MEAN_CHUNK) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every row of ``docs``."""
    spark = docs.sparkSession
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    shared_chunks = spark.sparkContext.broadcast(shared_filter(docs, bits, mean))

    def first(batches: Iterator) -> Iterator:
        """Finished documents, and of the others the parts and the shared chunks' texts."""
        import pandas as pd
        from pyspark import TaskContext

        own, table = codec(tokenizer, ranks), shared_chunks.value
        task, n, told = TaskContext.get().partitionId(), 0, set()

        def passes(k: bytes) -> bool:
            place = _short(k) % bits
            return bool(table[place >> 3] >> (place & 7) & 1)

        for batch in batches:
            rows: list[tuple] = []
            for doc, text in zip(batch["doc_id"], batch["text"], strict=True):
                data = (text or "").encode()
                parts = [(c, key(c)) for c in chunks(data, mean)]
                shared = [passes(k) for _, k in parts]
                row = task << 36 | n
                n += 1
                if not any(shared):
                    rows.append((0, row, doc, None, None, None, None, False, *_digest(own, own.encode(text or ""))))
                    continue
                rest, at = [], 0
                for (c, k), s in zip([*parts, (b"", b"")], [*shared, True], strict=True):
                    if not s:
                        rest.append(c)
                        continue
                    if rest:
                        ids = own.encode(b"".join(rest).decode())
                        rows.append((1, row, doc, at, None, None, _packed(ids), bool(len(ids) and ids.max() > 0xFFFF), None, None, None))
                        rest, at = [], at + 1
                    if k:
                        rows.append((1, row, doc, at, k, None, None, False, None, None, None))
                        at += 1
                        if k not in told:
                            told.add(k)
                            rows.append((2, None, None, None, k, c.decode(), None, False, None, None, None))
            names = ["what", "row", "doc_id", "at", "k", "chunk", "ids", "wide", "n_tokens", "ids_sha256", "decoded_sha256"]
            out = pd.DataFrame(rows, columns=names)
            for c in ("row", "at", "n_tokens"):
                out[c] = pd.array(out[c], dtype="Int64")
            yield out

    schema = f"what int, row long, doc_id {kind}, at long, k binary, chunk string, ids binary, wide boolean, {DIGEST}"
    met = written(docs.mapInPandas(first, schema), "bpe_parts")

    def once(batches: Iterator) -> Iterator:
        import pandas as pd

        own = codec(tokenizer, ranks)
        for batch in batches:
            ids = [own.encode(c) for c in batch["chunk"]]
            yield pd.DataFrame({"k": batch["k"], "chunk_ids": [_packed(i) for i in ids], "chunk_wide": [bool(i.max() > 0xFFFF) for i in ids]})

    texts = met.where("what = 2").select("k", "chunk").groupBy("k").agg(F.first("chunk").alias("chunk")).select("k", "chunk")
    encoded = written(texts.mapInPandas(once, "k binary, chunk_ids binary, chunk_wide boolean"), "bpe_chunks")
    parts = met.where("what = 1").select("row", "doc_id", "at", "k", "ids", "wide")
    held = parts.where("k IS NOT NULL").select("row", "doc_id", "at", "k").join(encoded, "k").select(
        "row", "doc_id", "at", F.col("chunk_ids").alias("ids"), F.col("chunk_wide").alias("wide")
    )
    together = held.unionByName(parts.where("k IS NULL").select("row", "doc_id", "at", "ids", "wide"))

    def assemble(batches: Iterator) -> Iterator:
        """Parts come sorted by row and place; a document may span batches."""
        import pyarrow as pa

        own, now, doc, parts = codec(tokenizer, ranks), None, None, []
        kinds: list = []

        def out(rows: list[tuple]):
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 4
            types = [kinds[0], pa.int64(), pa.string(), pa.string()]
            return pa.record_batch([pa.array(list(c), t) for c, t in zip(columns, types, strict=True)], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

        for batch in batches:
            kinds[:] = [batch.schema.field("doc_id").type]
            rows = []
            for row, d, blob, wide in zip(*(batch[c].to_pylist() for c in ("row", "doc_id", "ids", "wide")), strict=True):
                if row != now:
                    if now is not None:
                        rows.append((doc, *_digest(own, join_all(own, parts))))
                    now, doc, parts = row, d, []
                parts.append(_unpacked(blob, wide))
            yield out(rows)
        if now is not None:
            yield out([(doc, *_digest(own, join_all(own, parts)))])

    ordered = together.repartition("row").sortWithinPartitions("row", "at")
    joined = ordered.mapInArrow(assemble, f"doc_id {kind}, {DIGEST}")
    return met.where("what = 0").select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").unionByName(joined)
