"""Fill-in-middle forms of documents, cut at units found by one repeated capture."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Units: a word with the white space before it, or white space at the end. What
#: a quantifier has taken it never gives back, so no states are kept for that.
UNITS = regex.compile(r"([\x20\x09-\x0D]*+[^\x20\x09-\x0D]++|[\x20\x09-\x0D]++)*+")
SENTINEL = regex.compile("|".join(map(regex.escape, (PREFIX, SUFFIX, MIDDLE))))
#: Output characters after which a batch goes back to Spark.
BATCH_CHARS = 1 << 22
ADDED = "n long, form string, prefix_chars long, middle_chars long, output string"


def draws(doc_id: object, seed: int) -> list[int]:
    """The first four 32-bit numbers of the SHA-256 of ``seed:doc_id``."""
    known = "" if doc_id is None else doc_id
    digest = hashlib.sha256(f"{seed}:{known}".encode()).digest()
    return [int.from_bytes(digest[at : at + 4], "big") for at in range(0, 16, 4)]


def transformed(
    text: str | None, doc_id: object, seed: int = 42, rate: int = 50, spm_rate: int = 80
) -> tuple[int, str, int | None, int | None, str]:
    """``n, form, prefix_chars, middle_chars, output`` of one text."""
    text = text or ""
    ends = UNITS.fullmatch(text).ends(1)
    first, second, chance, order = draws(doc_id, seed)
    if not text or chance % 100 >= rate or SENTINEL.search(text):
        return len(ends), "plain", None, None, text
    low, high = sorted((first % (len(ends) + 1), second % (len(ends) + 1)))
    start = ends[low - 1] if low else 0
    stop = ends[high - 1] if high else 0
    prefix, middle, suffix = text[:start], text[start:stop], text[stop:]
    if order % 100 < spm_rate:
        form, output = "spm", f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    else:
        form, output = "psm", f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"
    return len(ends), form, start, stop - start, output


def fill_in_middle(docs: DataFrame, seed: int = 42, rate: int = 50, spm_rate: int = 80) -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output`` of every row.

    One full match of repeated units gives their ends, hence ``n`` and both cuts,
    which are drawn from a hash of seed and ``doc_id``: row order, partitions and
    repeated tasks don't matter, and equal rows get equal outputs. Of 100 texts
    about ``rate`` are cut, of those ``spm_rate`` in the form suffix first. A
    null or empty text, or one that holds a sentinel, stays plain, with null
    cuts. A null ``doc_id`` draws as an empty number. An empty table gives an
    empty one. Other columns are not read.
    """
    ids = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {ids}, {ADDED}"

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]
        names = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]
        for batch in batches:
            doc_ids, texts = batch.column(0), batch.column(1)
            rows, begun, chars = [], 0, 0
            for at in range(batch.num_rows):
                rows.append(transformed(texts[at].as_py(), doc_ids[at].as_py(), seed, rate, spm_rate))
                chars += len(rows[-1][-1])
                if chars >= BATCH_CHARS or at + 1 == batch.num_rows:
                    columns = [pa.array(c, t) for c, t in zip(zip(*rows), types)]
                    part = doc_ids.slice(begun, len(rows))
                    yield pa.RecordBatch.from_arrays([part, *columns], names)
                    rows, begun, chars = [], at + 1, 0

    return docs.select("doc_id", "text").mapInArrow(of, schema)


def _parted(text: Column, sentinel: str) -> tuple[Column, Column]:
    """What stands before and after the first ``sentinel``."""
    before = F.substring_index(text, sentinel, 1)
    return before, F.substring(text, F.length(before) + len(sentinel) + 1, F.length(text))


def restored(output: Column, form: Column) -> Column:
    """The text that gave ``output``: the parts hold no sentinel, so the first of
    each is the one that was put in."""
    begun = F.substring(output, len(PREFIX) + 1, F.length(output))
    prefix, rest = _parted(begun, SUFFIX)
    suffix, middle = _parted(rest, MIDDLE)
    psm = F.concat(prefix, middle, suffix)
    suffix, rest = _parted(begun, PREFIX)
    prefix, middle = _parted(rest, MIDDLE)
    spm = F.concat(prefix, middle, suffix)
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
