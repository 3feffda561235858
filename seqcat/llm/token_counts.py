"""Token counts without token ids.

Texts are cut into pre-tokens; a chunk of documents becomes one stored row: the chunk's distinct pre-tokens
and, per document, which of them it holds and how often.  All copies of a pre-token then meet in one
partition, its pieces are counted once, joined back to the chunks, and summed per document.  Frequent
pre-tokens cost one row per chunk, not one per occurrence.  Pre-tokens that the tokenizer's own vocabulary
file holds as one piece need no look-up.  Special strings of the tokenizer found in a text count one each,
as its library does by default.

Defined results: null and empty texts have no tokens; a null id is kept; repeated rows are counted each; an
empty table gives an empty result; extra columns of the input are ignored.
"""

from __future__ import annotations

import json
import re
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqcat.llm.common import slices, staged

CHUNK_BYTES = 32 << 20
LIMIT = 512
#: No pre-token crosses a single space between two characters that are no white space.
_BOUNDARY = re.compile(r"(?<=\S)(?= \S)")
_ODD_SPACE = re.compile(r"\s | \s|^ | $")
#: The splitter's published pattern over characters whose classes are beyond doubt; the library cuts the rest.
_LETTER, _PLAIN = "A-Za-zÀ-ÖØ-öø-ÿ", re.compile("[\t\n\r -~À-ÖØ-öø-ÿ]*")
_SPLIT = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTER}]+| ?[0-9]+| ?[^\s0-9{_LETTER}]+|\s+(?!\S)|\s+")


def _byte_letters() -> dict[int, str]:
    """The byte-level alphabet: printable Latin-1 bytes stand for themselves, the others follow from 256 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(rest)}


_LETTERS = _byte_letters()


def byte_level(word: str) -> str:
    return word.encode("utf-8", "surrogatepass").decode("latin-1").translate(_LETTERS)


class PreTokens:
    """Pre-tokens of texts, cached by unit (a word with the space before it)."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        spec = json.load(open(path, encoding="utf-8"))
        plain = {"single_word": False, "lstrip": False, "rstrip": False, "normalized": False}
        splitter = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
        if spec["normalizer"] or any(t[k] != v for t in spec["added_tokens"] for k, v in plain.items()) or any(
                spec["pre_tokenizer"].get(k) != v for k, v in splitter.items()):
            raise ValueError("only byte-level tokenizers without normalizer and with literal special strings are handled")
        special = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, special)) or "(?!)")
        tokenizer = Tokenizer.from_file(path)
        self.model, self.cut = tokenizer.model, tokenizer.pre_tokenizer.pre_tokenize_str
        self.single = {w for w in tokenizer.get_vocab(with_added_tokens=False) if len(self.model.tokenize(w)) == 1}
        self.clear()

    def clear(self) -> None:
        self.spaced: dict[str, int | tuple] = {}
        self.units: dict[str, int | tuple] = {}
        self.ids: dict[str, int] = {}

    def _unit(self, unit: str) -> int | tuple[int, list[int]]:
        """-1 for one single-piece pre-token, the id of one other, or (number of single ones, ids of others)."""
        cut = _SPLIT.findall(unit) if _PLAIN.fullmatch(unit) else [unit[a:b] for _, (a, b) in self.cut(unit)]
        words = [byte_level(w) for w in cut]
        others = [self.ids.setdefault(w, len(self.ids)) for w in words if w not in self.single]
        if len(words) == 1:
            return others[0] if others else -1
        return len(words) - len(others), others

    def count(self, text: str) -> tuple[int, dict[int, int]]:
        """Tokens that need no look-up, and the frequencies of the other pre-tokens."""
        parts = self.special.split(text)
        total = len(parts) - 1
        freq: dict[int, int] = {}
        for part in filter(None, parts):
            if _ODD_SPACE.search(part):
                found = [(self.units, "", Counter(_BOUNDARY.split(part)))]
            else:
                first, *rest = part.split(" ")
                found = [(self.units, "", {first: 1}), (self.spaced, " ", Counter(rest))]
            for cache, space, units in found:
                for unit, n in units.items():
                    v = cache.get(unit)
                    if v is None:
                        v = cache[unit] = self._unit(space + unit)
                    if v.__class__ is int:
                        if v < 0:
                            total += n
                        else:
                            freq[v] = freq.get(v, 0) + n
                    else:
                        total += v[0] * n
                        for i in v[1]:
                            freq[i] = freq.get(i, 0) + n
        return total, freq


def _packed(x: np.ndarray) -> bytes:
    return pa.compress(x.astype(np.int32).tobytes(), codec="zstd", asbytes=True)


def _unpacked(blob: bytes, n: int) -> np.ndarray:
    return np.frombuffer(pa.decompress(blob, decompressed_size=4 * n, codec="zstd"), dtype=np.int32)


def _chunks(path: str, chunk_bytes: int):
    """Documents -> one row per chunk; the ids of the documents' pre-tokens are stored as differences."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        pre = PreTokens(path)
        part, made, size = TaskContext.get().partitionId(), 0, 0
        docs: list[tuple] = []
        places: list[np.ndarray] = []
        counts: list[np.ndarray] = []

        def row() -> pa.RecordBatch:
            nothing = [np.zeros(0, dtype=np.int32)]
            doc_ids, n_bytes, known, lengths = (list(x) for x in zip(*docs, strict=True))
            return pa.record_batch({
                "chunk": pa.array([part << 32 | made], pa.int64()), "pretokens": pa.array([list(pre.ids)], pa.list_(pa.string())),
                "doc_ids": pa.array([doc_ids], pa.list_(pa.int64())), "n_bytes": pa.array([n_bytes], pa.list_(pa.int64())),
                "known": pa.array([known], pa.list_(pa.int64())), "lengths": pa.array([lengths], pa.list_(pa.int64())),
                "ids": pa.array([_packed(np.diff(np.concatenate(nothing + places), prepend=np.int32(0)))], pa.binary()),
                "counts": pa.array([_packed(np.concatenate(nothing + counts))], pa.binary())})

        for b in slices(batches):
            for doc_id, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist(), strict=True):
                known, freq = pre.count(text or "")
                order = sorted(freq)
                places.append(np.array(order, dtype=np.int32))
                counts.append(np.array([freq[i] for i in order], dtype=np.int32))
                n = len((text or "").encode("utf-8", "surrogatepass"))
                docs.append((doc_id, n, known, len(order)))
                size += n
                if size >= chunk_bytes:
                    yield row()
                    pre.clear()
                    made, size = made + 1, 0
                    docs, places, counts = [], [], []
        if docs:
            yield row()
    return run


def _pieces(path: str):
    """Rows sorted by pre-token -> (chunk, place, pieces); each distinct pre-token is counted once."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from tokenizers import Tokenizer

        tokenize = Tokenizer.from_file(path).model.tokenize
        last, n = None, 0
        for b in batches:
            out = []
            for w in b.column("pretoken").to_pylist():
                if w != last:
                    last, n = w, len(tokenize(w))
                out.append(n)
            yield pa.record_batch({"chunk": b.column("chunk"), "place": b.column("place"), "pieces": pa.array(out, pa.int32())})
    return run


def _sums(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for r in range(b.num_rows):
            row = {c: b.column(c)[r] for c in b.schema.names}
            lengths = np.array(row["lengths"].values, dtype=np.int64)
            ids, counts = (_unpacked(row[c].as_py(), int(lengths.sum())) for c in ("ids", "counts"))
            pieces = np.zeros(len(row["places"].values) if row["places"].is_valid else 0, dtype=np.int64)
            if len(pieces):
                pieces[np.array(row["places"].values)] = np.array(row["pieces"].values)
            total = np.concatenate([[0], np.cumsum(pieces[np.cumsum(ids)] * counts)]) if len(ids) else np.zeros(1, dtype=np.int64)
            ends = np.cumsum(lengths)
            yield pa.record_batch({"doc_id": row["doc_ids"].values, "n_bytes": row["n_bytes"].values, "n_tokens": pa.array(
                total[ends] - total[ends - lengths] + np.array(row["known"].values, dtype=np.int64), pa.int64())})


def token_counts(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                 chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """(doc_id, n_bytes, n_tokens) of every row.  ``tokenizer_path`` is a file that every worker can open."""
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    chunks = staged(docs.mapInArrow(_chunks(tokenizer_path, chunk_bytes), (
        "chunk long, pretokens array<string>, doc_ids array<long>, n_bytes array<long>, known array<long>, "
        "lengths array<long>, ids binary, counts binary")), "token-chunks")
    words = chunks.select("chunk", F.posexplode("pretokens").alias("place", "pretoken"))
    pieces = (words.repartition("pretoken").sortWithinPartitions("pretoken")
              .mapInArrow(_pieces(tokenizer_path), "chunk long, place int, pieces int"))
    back = pieces.groupBy("chunk").agg(F.collect_list("place").alias("places"),  # a chunk's own pre-tokens
                                       F.collect_list("pieces").alias("pieces"))
    return chunks.drop("pretokens").join(back, "chunk", "left").mapInArrow(_sums, "doc_id long, n_bytes long, n_tokens long")


def op7_token_counts(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    out = token_counts(docs, tokenizer_path)
    return out.withColumn("over_limit", F.col("n_tokens") > LIMIT)
