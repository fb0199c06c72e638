"""Fill-in-the-middle transformation: documents cut into prefix, middle and suffix, which change places.

A text is a repetition of units (by default code points). One ``fullmatch`` of a repeated group, with the ``regex`` library,
keeps every repetition: the ends of that group are the places between units, so their number is the number of units and
two of them are the cuts. Nothing steps through a text in Python. A match keeps at most ``MOST`` repetitions, so that
memory stays bounded; a text of more units is matched on from where the last match ended.

Which units the cuts follow, whether a text is changed and in which order come from ``sha256("<seed>:<key>")``:
psm writes prefix, suffix, middle, spm writes suffix, prefix, middle, each after its marker; plain leaves the text as it is.

Defined cases: a null text counts as empty and a null key as ''; empty texts, texts that hold a marker, and texts that
are no repetition of the unit (their ``n`` is null) are plain; repeated rows come out alike; an empty table gives an empty result; other
columns are not read.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Callable

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from transferlens.llm.language import blocks, text_bytes

# Fixed values of the contract: markers of prefix, suffix and middle, and shares in percent.
MARKERS = ("<P>", "<S>", "<M>")
CHANGED = 90
SUFFIX_FIRST = 20
SEED = "1"
UNIT = r"(?s:.)"
MOST = 1 << 18
BLOCK = 4 << 20
SCHEMA = "key bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string"


def repeated(unit: str = UNIT, most: int = MOST) -> regex.Pattern:
    return regex.compile(f"({unit}){{0,{most}}}+")


def measured(pattern: regex.Pattern, text: str) -> tuple[int, Callable[[int], int]] | None:
    """The number of units and where the first k of them end; None if the text is no repetition of units."""
    whole = pattern.fullmatch(text)
    if whole:
        ends = [0, *whole.ends(1)]
        return len(ends) - 1, ends.__getitem__
    starts, before = [0], [0]
    while starts[-1] < len(text):
        part = pattern.match(text, starts[-1])
        if part.end() == starts[-1]:
            return None
        starts.append(part.end())
        before.append(before[-1] + len(part.ends(1)))

    def end(units: int) -> int:
        at = bisect_left(before, units)
        return starts[at] if before[at] == units else pattern.match(text, starts[at - 1]).ends(1)[units - before[at - 1] - 1]

    return before[-1], end


def draws(key: Column, seed: str) -> list[Column]:
    """Four unsigned numbers of 32 bits: the first groups of eight digits of a sha256."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long").alias(f"h{i + 1}") for i in range(4)]


def rearranged(text: str, h: tuple[int, ...], pattern: regex.Pattern, markers: tuple[str, str, str], changed: int, suffix_first: int):
    """n, form, prefix and middle length in code points, output."""
    units = measured(pattern, text)
    n = units and units[0]
    if not n or h[2] % 100 >= changed or any(m in text for m in markers):
        return n, "plain", None, None, text
    a, b = (units[1](k) for k in sorted((h[0] % (n + 1), h[1] % (n + 1))))
    prefix, middle, suffix = (f"{mark}{part}" for mark, part in zip((markers[0], markers[2], markers[1]), (text[:a], text[a:b], text[b:]), strict=True))
    if h[3] % 100 < suffix_first:
        return n, "spm", a, b - a, suffix + prefix + middle
    return n, "psm", a, b - a, prefix + suffix + middle


def fill_in_middle(docs: DataFrame, key: str = "doc_id", text: str = "text", seed: str = SEED, markers: tuple[str, str, str] = MARKERS,
                   changed: int = CHANGED, suffix_first: int = SUFFIX_FIRST, unit: str = UNIT, most: int = MOST) -> DataFrame:
    """One row per document: key, n (units), form, prefix_chars, middle_chars (null if plain), output."""
    rows = docs.select(F.col(key).cast("long").alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"), *draws(F.col(key), seed))

    def transform(batches):
        pattern = repeated(unit, most)
        schema = pa.schema([("key", pa.int64()), ("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()), ("output", pa.string())])
        for batch in batches:
            _, ends = text_bytes(batch.column("text"))
            for i, j in blocks(ends, BLOCK):
                part = batch.slice(i, j - i)
                h = zip(*(part.column(f"h{k}").to_pylist() for k in range(1, 5)), strict=True)
                out = [rearranged(t, x, pattern, markers, changed, suffix_first) for t, x in zip(part.column("text").to_pylist(), h, strict=True)]
                yield pa.RecordBatch.from_arrays([part.column("key"), *(pa.array(list(c), f.type) for c, f in zip(zip(*out, strict=True), list(schema)[1:], strict=True))], schema=schema)

    return rows.mapInArrow(transform, SCHEMA)


def restored(output: Column, form: Column, markers: tuple[str, str, str] = MARKERS) -> Column:
    """The text that an output was made from. Changed texts hold no marker, so the first occurrence of each is the one set here."""
    def between(first: str, second: str, third: str) -> tuple[Column, Column, Column]:
        one = F.substring_index(F.substring(output, F.lit(len(first) + 1), F.length(output)), second, 1)
        rest = F.substring(output, F.length(one) + len(first) + len(second) + 1, F.length(output))
        two = F.substring_index(rest, third, 1)
        return one, two, F.substring(rest, F.length(two) + len(third) + 1, F.length(rest))

    prefix, suffix, middle = markers
    psm, spm = between(prefix, suffix, middle), between(suffix, prefix, middle)
    return F.when(form == "psm", F.concat(psm[0], psm[2], psm[1])).when(form == "spm", F.concat(spm[1], spm[2], spm[0])).otherwise(output)
