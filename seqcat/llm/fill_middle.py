"""Fill-in-middle: texts cut at unit ends into prefix, middle and suffix, written out in another order.

The cuts are found with whole machine words (SWAR).  The UTF-8 bytes of a batch of texts are viewed as uint64
words; arithmetic on whole words sets the top bit of every byte that ends a unit; ``bitwise_count`` gives the
marks of each word and a running sum those before it.  The place of a text's k-th unit end is a binary search in the
running sums, which finds the word, and a select inside that word.  All texts of a batch are cut at
once; only the final copying of the parts is per text.

Units are ``line`` (``[^\\n]*\\n|[^\\n]+``) or ``char`` (code point).  Forms: ``psm`` writes prefix, suffix, middle; ``spm`` writes
suffix, prefix, middle; ``plain`` leaves the text as it is.  Four draws per document come from SHA-256 of seed
and id, so reruns and repeated rows agree.

Defined results: a null text is empty; an empty text, or one that holds a sentinel, is plain; a null id is
drawn as the empty string; ties and repeated rows are rows like any other; an empty table gives an empty
result; other columns are ignored.  The output of a text must fit in a row.
"""

from __future__ import annotations

import sys
from collections.abc import Iterable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seqcat.llm.common import slices

SEED = 7
SENTINELS = ("<P>", "<S>", "<M>")
FIM_PERCENT = 100
SPM_PERCENT = 50

_TOP = np.uint64(0x8080808080808080)
_LOW = np.uint64(0x7F7F7F7F7F7F7F7F)
_NEWLINE = np.uint64(0x0A0A0A0A0A0A0A0A)
_ONE = np.uint64(1)


def word_view(data: np.ndarray) -> np.ndarray:
    """Bytes as little-endian uint64 words, zeros behind the last byte, and one zero word more."""
    padded = np.zeros((len(data) // 8 + 2) * 8, dtype=np.uint8)
    padded[:len(data)] = data
    words = padded.view("<u8")
    return words if sys.byteorder == "little" else words.astype(np.uint64)


def newline_marks(words: np.ndarray) -> np.ndarray:
    """The top bit of every byte 0x0A; no carry leaves a byte."""
    x = words ^ _NEWLINE
    return ~(((x & _LOW) + _LOW) | x | _LOW)


def start_marks(words: np.ndarray) -> np.ndarray:
    """The top bit of every byte that is no UTF-8 continuation byte (10xxxxxx)."""
    return ~(words & ~(words << _ONE)) & _TOP


class Marks:
    """Rank and select over the marked bytes of a buffer."""

    def __init__(self, marks: np.ndarray) -> None:
        self.marks = marks
        self.before = np.zeros(len(marks) + 1, dtype=np.int64)
        np.cumsum(np.bitwise_count(marks), out=self.before[1:])

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Marked bytes before each byte position."""
        word, bits = at >> 3, ((at & 7) * 8).astype(np.uint64)
        inside = self.marks[word] & ((_ONE << bits) - _ONE)
        return self.before[word] + np.bitwise_count(inside)

    def select(self, k: np.ndarray) -> np.ndarray:
        """Byte position of the k-th mark (from 1), which must exist."""
        word = np.searchsorted(self.before, k, side="left") - 1
        left, rest = self.marks[word], k - self.before[word]
        for step in range(1, 8):  # clear the lowest mark until the wanted one is the lowest
            left = np.where(rest > step, left & (left - _ONE), left)
        low = left & (~left + _ONE)
        return word * 8 + (np.bitwise_count(low - _ONE) >> 3)


class Units:
    """Unit counts and unit ends of texts that lie one after another in a buffer (``offsets``, one more than texts)."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, unit: str) -> None:
        words = word_view(data)
        self.start, self.end, self.unit = offsets[:-1], offsets[1:], unit
        self.chars = Marks(start_marks(words))
        self.marks = Marks(newline_marks(words)) if unit == "line" else self.chars
        self.first = self.marks.rank(self.start)
        self.marked = self.marks.rank(self.end) - self.first
        self.count = self.marked.copy()
        if unit == "line":  # a last line without its newline
            last = data[np.maximum(self.end - 1, 0)] if len(data) else np.zeros(len(self.end), np.uint8)
            self.count += (self.end > self.start) & (last != 10)

    def after(self, k: np.ndarray) -> np.ndarray:
        """Byte position behind the first k units of each text (0 <= k <= count)."""
        out = np.where(k == 0, self.start, self.end)
        if self.unit == "line":  # marks are the units' last bytes
            inner = np.flatnonzero((k > 0) & (k <= self.marked))
            out[inner] = self.marks.select(self.first[inner] + k[inner]) + 1
        else:  # marks are the units' first bytes: the next unit's begins behind this one
            inner = np.flatnonzero((k > 0) & (k < self.marked))
            out[inner] = self.marks.select(self.first[inner] + k[inner] + 1)
        return out

    def chars_between(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return self.chars.rank(b) - self.chars.rank(a)


def _transform(unit: str, fim: int, spm: int, sentinels: tuple[bytes, ...], batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    p_mark, s_mark, m_mark = sentinels
    for b in slices(batches):
        texts = [(t or "").encode("utf-8", "surrogatepass") for t in b.column("text").to_pylist()]
        offsets = np.zeros(len(texts) + 1, dtype=np.int64)
        np.cumsum([len(t) for t in texts], out=offsets[1:])
        units = Units(np.frombuffer(b"".join(texts), dtype=np.uint8), offsets, unit)
        h = [b.column(f"h{i}").to_numpy(zero_copy_only=False).astype(np.int64) for i in range(1, 5)]
        ends = [h[i] % (units.count + 1) for i in (0, 1)]
        a, z = units.after(np.minimum(*ends)), units.after(np.maximum(*ends))
        plain = (units.end == units.start) | (h[2] % 100 >= fim)
        plain |= np.fromiter((any(s in t for s in sentinels) for t in texts), dtype=bool, count=len(texts))
        as_spm = h[3] % 100 < spm
        outputs, forms = [], []
        for t, i, j, is_plain, is_spm in zip(texts, (a - units.start).tolist(), (z - units.start).tolist(), plain.tolist(), as_spm.tolist(),
                                             strict=True):
            forms.append("plain" if is_plain else "spm" if is_spm else "psm")
            if is_plain:
                outputs.append(t)
            elif is_spm:
                outputs.append(b"".join((s_mark, t[j:], p_mark, t[:i], m_mark, t[i:j])))
            else:
                outputs.append(b"".join((p_mark, t[:i], s_mark, t[j:], m_mark, t[i:j])))
        yield pa.record_batch({
            "doc_id": b.column("doc_id"), "n": pa.array(units.count, pa.int64()), "form": pa.array(forms, pa.string()),
            "prefix_chars": pa.array(units.chars_between(units.start, a), pa.int64(), mask=plain),
            "middle_chars": pa.array(units.chars_between(a, z), pa.int64(), mask=plain),
            "output": pa.array(outputs, pa.binary()).cast(pa.string())})


def draws(id_col: str, seed: int = SEED) -> list[Column]:
    """h1 to h4: the first four 8-digit groups of SHA-256 of ``seed:id``."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long").alias(f"h{i + 1}") for i in range(4)]


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", unit: str = "line", seed: int = SEED,
                   fim_percent: int = FIM_PERCENT, spm_percent: int = SPM_PERCENT, sentinels: tuple[str, str, str] = SENTINELS) -> DataFrame:
    """One row per document: doc_id, n (units), form, prefix_chars, middle_chars, output (the training text)."""
    if unit not in ("line", "char"):
        raise ValueError(f"unit is 'line' or 'char', not {unit!r}")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), *draws(id_col, seed))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    run = partial(_transform, unit, fim_percent, spm_percent, tuple(s.encode() for s in sentinels))
    return rows.mapInArrow(run, f"doc_id {id_type}, n long, form string, prefix_chars long, middle_chars long, output string")


def restored(output: Column, form: Column, sentinels: tuple[str, str, str] = SENTINELS) -> Column:
    """The text rebuilt from output and form alone."""
    p, s, m = sentinels
    first, last = F.when(form == "spm", F.lit(s)).otherwise(F.lit(p)), F.when(form == "spm", F.lit(p)).otherwise(F.lit(s))
    body = F.substring(output, F.length(first) + 1, F.length(output))
    at = F.instr(body, last)
    one = F.substring(body, F.lit(1), at - 1)
    rest = F.substring(body, at + F.length(last), F.length(body))
    at = F.instr(rest, F.lit(m))
    two, middle = F.substring(rest, F.lit(1), at - 1), F.substring(rest, at + len(m), F.length(rest))
    return F.when(form == "plain", output).when(form == "spm", F.concat(two, middle, one)).otherwise(F.concat(one, middle, two))


def op12_fill_in_middle(docs: DataFrame) -> DataFrame:
    out = fill_in_middle(docs)
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                      F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


ORACLE = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS x,
         regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS u
  FROM documents),
h AS (
  SELECT *, len(u) AS n, ('0x' || x[1:8])::BIGINT % (len(u) + 1) AS k1, ('0x' || x[9:16])::BIGINT % (len(u) + 1) AS k2,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR ('0x' || x[17:24])::BIGINT % 100 >= 100
              THEN 'plain' WHEN ('0x' || x[25:32])::BIGINT % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
  FROM d),
p AS (
  SELECT doc_id, t, n, form, array_to_string(u[1:least(k1, k2)], '') AS a,
         array_to_string(u[least(k1, k2) + 1:greatest(k1, k2)], '') AS b, array_to_string(u[greatest(k1, k2) + 1:], '') AS c
  FROM h)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(a) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(b) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || a || '<S>' || c || '<M>' || b
                        ELSE '<S>' || c || '<P>' || a || '<M>' || b END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM p
"""
