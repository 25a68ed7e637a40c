"""Token ids in directly addressable files (operator 2).

Directly addressable codes: an id is cut into chunks of ``CHUNK_BITS`` bits. Level 0 holds the lowest chunk of every id,
level 1 the next chunk of the ids that have one, and so on. Each level has a bitmap of the entries that continue
on the next level and a rank directory (ones before each block of ``RANK_BLOCK`` entries), so entry i of a
level is found on the next one at rank(i): any token is read in one step per level, without decoding its neighbours.

A file is (little-endian): magic, n_docs, n_tokens, n_levels; keys, null marks and token ends of its documents; per level
its number of entries, chunks, bitmap, rank directory. Documents are dealt to files by ranges of (key, text digest) and
sorted, so the files in order hold the ids in ascending key order. Files are written under a temporary name and
moved, and the same rows give the same bytes: a repeated task replaces its file by an equal one.

Defined cases: a null text is empty and holds the end id only; null keys come first; rows with equal keys are in order of a
digest of their texts; an empty table gives no file; only the key and the text column are read. Strings of
special tokens in a text are ordinary text. Texts are encoded whole.
"""

from __future__ import annotations

import os
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from runlens.llm.common import cut
from runlens.session import scratch_path

MAGIC = b"DACTOK01"
CHUNK_BITS = 8
RANK_BLOCK = 512
FILE_TEXT_BYTES = 32 << 20
KEPT_CHUNKS = 1_000_000


# ---- encoding ---------------------------------------------------------------------------------------------

# Characters whose class no version of Unicode changed, with no white space but space and line end; a text
# with any other is encoded whole.
OTHER = regex.compile(r"[^\n -~\u00a1-\u024f\u2010-\u2027]")


def _in_order(text: str) -> bool:
    """No rare characters, no two white-space characters in a row."""
    plain = text.replace("\n", " ")
    if "  " in plain:
        return False
    return plain.isprintable() if text.isascii() else not OTHER.search(text)


class Encoder:
    """Ids of texts by a tokenizers file, as little-endian bytes.

    A byte-level file merges inside pieces only, and no piece reaches over a space or line end that stands
    alone, so a text is cut there and each distinct chunk is encoded once. Texts with runs of white space or
    with rare characters, and other kinds of files, are encoded whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        kind = type(self.tokenizer.pre_tokenizer).__name__
        self.in_chunks = kind == "ByteLevel" and self.tokenizer.normalizer is None \
            and not self.tokenizer.pre_tokenizer.add_prefix_space
        self.chunks: dict[str, bytes] = {}   # a key without line end in front stands after a space
        if self.in_chunks:
            # A byte-level vocabulary writes each byte as one character.
            vocabulary = self.tokenizer.get_vocab()
            self.token_bytes = np.zeros(max(vocabulary.values()) + 1, np.int64)
            self.token_bytes[list(vocabulary.values())] = list(map(len, vocabulary))
            self._learn(["\n"])

    def ids(self, text: str) -> bytes:
        if not self.in_chunks or not _in_order(text):
            return np.asarray(self._encoded(text), "<u4").tobytes()
        if len(self.chunks) > KEPT_CHUNKS:
            self.chunks = {}
            self._learn(["\n"])
        known, parts = self.chunks, self._parts(text)
        found = list(map(known.get, parts))
        if None in found:
            missing = [i for i, x in enumerate(found) if x is None]
            self._learn(list({parts[i] for i in missing}))
            for i in missing:
                found[i] = known[parts[i]]
        own = b"".join(found)
        # A first word without white space in front was looked up with a line end.
        return own if text[:1] in ("", " ", "\n") else own[len(known["\n"]):]

    def _learn(self, new: list[str]) -> None:
        # Chunks with a word stand behind one another as in a text, so one call encodes them all, and the bytes of
        # its tokens tell where each ends; should one not end with a token, they are encoded one by one.
        worded = [x for x in new if x and x != "\n"]
        texts = [x if x[0] == "\n" else " " + x for x in worded]
        ids = np.asarray(self._encoded("".join(texts)), "<u4")
        ends = np.cumsum([len(x.encode()) for x in texts])
        upto = np.cumsum(self.token_bytes[ids])
        cuts = np.searchsorted(upto, ends)
        if len(texts) and (cuts[-1] >= len(upto) or (upto[cuts] != ends).any()):
            self._learn_alone(worded)
        else:
            held, at = ids.tobytes(), ((cuts + 1) * 4).tolist()
            self.chunks.update(zip(worded, [held[i:j] for i, j in zip([0, *at], at)]))
        self._learn_alone([x for x in new if not x or x == "\n"])

    def _learn_alone(self, new: list[str]) -> None:
        for x in new:
            self.chunks[x] = np.asarray(self._encoded(x if x[:1] == "\n" else " " + x), "<u4").tobytes()

    def _encoded(self, text: str) -> list[int]:
        return self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids

    @staticmethod
    def _parts(text: str) -> list[str]:
        """Chunks without the space before them; the first of a text that starts with a word follows a line end."""
        parts = text.replace("\n", " \n").split(" ")
        if parts[0]:
            return ["\n" + parts[0], *parts[1:]]
        return parts[1:]


# One per worker process and file: later tasks find the pieces of earlier ones.
_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


# ---- the file format --------------------------------------------------------------------------------------

def levels_of(ids: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(chunks, bitmap, ranks) per level."""
    out, left = [], ids.astype(np.uint32)
    while True:
        chunk = (left & np.uint32((1 << CHUNK_BITS) - 1)).astype(np.uint8)
        high = left >> np.uint32(CHUNK_BITS)
        more = high > 0
        ones = np.add.reduceat(more, np.arange(0, len(more), RANK_BLOCK), dtype=np.uint64) if len(more) else np.zeros(0, np.uint64)
        out.append((chunk, np.packbits(more, bitorder="little"), np.cumsum(ones) - ones))
        if not more.any():
            return out
        left = high[more]


def to_bytes(keys: list[int | None], lengths: np.ndarray, ids: np.ndarray) -> bytes:
    levels = levels_of(ids)
    parts = [MAGIC, np.array([len(keys), len(ids), len(levels)], "<u8").tobytes(),
             np.array([k or 0 for k in keys], "<i8").tobytes(), np.array([k is None for k in keys], "u1").tobytes(),
             np.cumsum(lengths).astype("<u8").tobytes()]
    for chunk, bitmap, ranks in levels:
        parts += [np.array([len(chunk)], "<u8").tobytes(), chunk.tobytes(), bitmap.tobytes(), ranks.astype("<u8").tobytes()]
    return b"".join(parts)


class TokenFile:
    """Random access to one file's tokens and documents."""

    def __init__(self, data: bytes):
        if data[:8] != MAGIC:
            raise ValueError("not a token file")
        self._at, self._data = 8, data
        n_docs, self.n_tokens, n_levels = (int(x) for x in self._take("<u8", 3))
        keys, null = self._take("<i8", n_docs), self._take("u1", n_docs)
        self.keys = [None if z else int(k) for k, z in zip(keys, null)]
        self.ends = self._take("<u8", n_docs).astype(np.int64)
        self.levels = []
        for _ in range(n_levels):
            n = int(self._take("<u8", 1)[0])
            self.levels.append((self._take("u1", n), self._take("u1", -(-n // 8)), self._take("<u8", -(-n // RANK_BLOCK))))

    def _take(self, dtype: str, n: int) -> np.ndarray:
        out = np.frombuffer(self._data, dtype, n, self._at)
        self._at += out.nbytes
        return out

    def token(self, i: int) -> int:
        """Token i: per level one chunk, one bit and one rank."""
        if not 0 <= i < self.n_tokens:
            raise IndexError(i)
        value = shift = 0
        for chunk, bitmap, ranks in self.levels:
            value |= int(chunk[i]) << shift
            if not bitmap[i >> 3] >> (i & 7) & 1:
                break
            block = i // RANK_BLOCK
            inside = np.unpackbits(bitmap[block * RANK_BLOCK // 8:(i >> 3) + 1], bitorder="little")[:i - block * RANK_BLOCK]
            i, shift = int(ranks[block]) + int(inside.sum()), shift + CHUNK_BITS
        return value

    def tokens(self, lo: int, hi: int) -> np.ndarray:
        """Tokens lo to hi, level by level: on each, the entries of a range are a range again."""
        parts = []
        for chunk, bitmap, ranks in self.levels:
            block = lo // RANK_BLOCK
            bits = np.unpackbits(bitmap[block * RANK_BLOCK // 8:-(-hi // 8)], bitorder="little")[:hi - block * RANK_BLOCK].astype(bool)
            skip = lo - block * RANK_BLOCK
            more = bits[skip:]
            parts.append((chunk[lo:hi], more))
            n = int(more.sum())
            if not n:
                break
            lo = int(ranks[block]) + int(bits[:skip].sum())
            hi = lo + n
        value = np.zeros(0, np.uint32)
        for chunk, more in reversed(parts):
            here = chunk.astype(np.uint32)
            here[more] |= value << np.uint32(CHUNK_BITS)
            value = here
        return value

    def document(self, k: int) -> np.ndarray:
        return self.tokens(int(self.ends[k - 1]) if k else 0, int(self.ends[k]))


# ---- Spark ------------------------------------------------------------------------------------------------

def _store(folder: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder)


def _file_writer(folder: str, tokenizer_path: str, end_id: int):
    end = np.array([end_id], "<u4").tobytes()

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode, keys, lengths, parts = encoder(tokenizer_path), [], [], []
        for batch in batches:
            for text in batch["text"]:
                ids = encode.ids(text)
                lengths.append(len(ids) // 4 + 1)
                parts += [ids, end]
            keys += [None if pd.isna(k) else int(k) for k in batch["key"]]
        if not keys:
            return
        part = TaskContext.get().partitionId()
        name = f"part-{part:07d}.dac"
        data = to_bytes(keys, np.array(lengths, np.int64), np.frombuffer(b"".join(parts), "<u4"))
        store, path = _store(folder)
        store.create_dir(path)
        temporary = f"{path}/.{name}.{uuid.uuid4().hex}"
        with store.open_output_stream(temporary) as out:
            out.write(data)
        store.move(temporary, f"{path}/{name}")
        yield pd.DataFrame({"part": [part], "file": [name], "docs": [len(keys)], "tokens": [sum(lengths)]})

    return write


def write_tokens(df: DataFrame, key: str, text: str, folder: str, tokenizer_path: str, end_id: int,
                 file_bytes: int = FILE_TEXT_BYTES) -> DataFrame:
    """Write the files; returns (part, file, docs, tokens, start) per file, ``start`` = tokens of the files before it.

    The number of files follows the input's bytes, so a task holds about ``file_bytes`` of text (more only for one longer text).
    """
    docs = df.select(F.col(key).cast("long").alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    n = size // file_bytes + 1
    order = [F.col("key"), F.xxhash64("text")]
    dealt = docs.repartitionByRange(int(n), *order).sortWithinPartitions(*order)
    files = cut(dealt.mapInPandas(_file_writer(folder, tokenizer_path, end_id),
                                  "part int, file string, docs long, tokens long"), "token-files")
    before = F.sum("tokens").over(Window.orderBy("part")) - F.col("tokens")
    return files.withColumn("start", before)


def _file_reader(folder: str):
    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, path = _store(folder)
        for batch in batches:
            for name, start in zip(batch["file"], batch["start"]):
                with store.open_input_file(f"{path}/{name}") as held:
                    f = TokenFile(held.read())
                begins = np.concatenate([[0], f.ends[:-1]])
                sums = [zlib.crc32(f.document(k).astype("<u4").tobytes()) for k in range(len(f.keys))]
                yield pd.DataFrame({"key": pd.array(f.keys, dtype="Int64"), "start": begins + start,
                                    "n_tokens": f.ends - begins, "ids_crc32": sums})

    return read


def read_documents(files: DataFrame, folder: str) -> DataFrame:
    """(key, start, n_tokens, ids_crc32) per document, from the files alone."""
    return files.select("file", "start").repartition(max(1, files.count())).mapInPandas(
        _file_reader(folder), "key long, start long, n_tokens long, ids_crc32 long")


def token_folder(spark) -> str:
    return scratch_path(spark, "tokens")
