"""Secret scans: patterns, and strings near sensitive words that zstandard cannot compress.

Base spans come from three patterns. Beyond them, a candidate is a run of ``RUN`` characters, at least
``SHORTEST`` long, with a letter and a digit, that begins at most ``NEAR`` characters after a sensitive
word in the same line and overlaps no base span. Its novelty is what it adds, in compressed bytes per
byte, to what is known: zstandard is primed with a raw dictionary of the corpus's identifiers, and the
surrounding text is compressed with and without the candidate behind it. Names and paths that are put
together from known identifiers become references; keys do not. Candidates of ``NOVEL`` or more are
reported.

The identifiers are those of all lines of all documents that hold a sensitive word, by the number of
documents that have them, up to ``DICTIONARY`` bytes, which bounds the broadcast. Words with digits
are left out, and candidates, base spans and the candidate's repetitions are cut out of the
surroundings, so that a key that occurs several times, in one document or in copies, does not make
itself known.

Every document is scanned by itself, whole. Null and empty texts have no spans; rows stay as they are,
repeated ones and extra columns included (an input column named ``spans`` is replaced).
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinfold.llm import words as wd

SHORTEST = 16
NEAR = 64
BEFORE, AFTER = 1024, 256  # characters of the surroundings
NOVEL = 0.62  # random strings measured 0.65 and more, names made of known words 0.62 and less
DICTIONARY = 64 << 10
LEVEL = 19
_CARRIER = 512  # the most frequent identifiers stand before the surroundings, which may be short

# The patterns of the base spans, in the order of their kinds.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")  # a run of 32 or more is found whole
KINDS = ("assign", "access", "hex", "novel")

SENSITIVE = (
    r"pass(?:word|wd|phrase|code)|pwd|secret|token|credential|bearer|authorization"
    r"|(?:api|access|private|signing|encryption|client|account)[_\x20-]?key"
)
_SENSITIVE = re.compile(f"(?={SENSITIVE})", re.IGNORECASE | re.ASCII)
RUN = r"[A-Za-z0-9+/_.=~-]"
_RUN = re.compile(f"{RUN}+")
_IDENTIFIER = rf"(?<!{RUN})[A-Za-z_]{{4,}}(?!{RUN})"
SPAN = "struct<kind:string,start:int,end:int,value_start:int,novelty:double>"


class Span(NamedTuple):
    kind: str
    start: int
    end: int
    value_start: int  # where the secret itself begins, behind a name and an equals sign
    novelty: float | None


def base_spans(text: str) -> list[Span]:
    """Spans of the three patterns, by start, then kind."""
    found = [
        Span("assign", m.start(), m.end(), m.start(2), None)
        for m in ASSIGN.finditer(text)
        if len(m[2]) >= 8
    ]
    found += [
        Span("access", *m.span(), m.start(), None) for m in ACCESS.finditer(text) if len(m[0]) >= 16
    ]
    found += [Span("hex", *m.span(), m.start(), None) for m in HEX.finditer(text)]
    return in_order(found)


def in_order(spans: list[Span]) -> list[Span]:
    return sorted(spans, key=lambda s: (s.start, KINDS.index(s.kind), s.end))


def _shape(value: str) -> bool:
    return (
        len(value) >= SHORTEST
        and any(c.isdigit() for c in value)
        and any(c.isalpha() for c in value)
    )


def candidates(text: str, base: list[Span]) -> list[tuple[int, int]]:
    """Runs near sensitive words that overlap no base span, in order."""
    found: dict[int, int] = {}
    for word in _SENSITIVE.finditer(text):
        at = word.start()
        stop = text.find("\n", at)
        stop = len(text) if stop < 0 else stop
        for run in _RUN.finditer(text, at, stop):
            if run.start() > at + NEAR:
                break
            a, b = run.start(), run.end()
            while b > a and text[b - 1] in ".=":  # ends of sentences, padding
                b -= 1
            if a not in found and _shape(text[a:b]):
                found[a] = b
    spans: list[tuple[int, int]] = []
    starts = [s.start for s in base]
    ends = [0]  # the largest end of the first i base spans
    for s in base:
        ends.append(max(ends[-1], s.end))
    for a, b in sorted(found.items()):
        if spans and a < spans[-1][1]:  # begins inside an earlier one
            continue
        if ends[bisect_left(starts, b)] <= a:
            spans.append((a, b))
    return spans


def _without(text: str, a: int, b: int, holes: list[tuple[int, int]]) -> str:
    """``text[a:b]`` without ``holes``, which are in order."""
    parts = []
    for start, end in holes[max(0, bisect_left(holes, (a, a)) - 1) :]:
        if start >= b:
            break
        if end > a:
            parts.append(text[a:start])
            a = max(a, end)
    parts.append(text[a:b])
    return "".join(parts)


class Novelty:
    """Compressed bytes that a value adds to its surroundings, per byte."""

    def __init__(self, identifiers: bytes) -> None:
        import zstandard

        raw = zstandard.DICT_TYPE_RAWCONTENT
        known = zstandard.ZstdCompressionDict(identifiers or b" ", dict_type=raw)
        self._carrier = identifiers[-_CARRIER:]
        self._size = lambda data: len(
            zstandard.ZstdCompressor(
                level=LEVEL,
                dict_data=known,
                write_checksum=False,
                write_content_size=False,
                write_dict_id=False,
            ).compress(data)
        )

    def __call__(self, value: str, surroundings: str) -> float:
        known, own = self._carrier + surroundings.encode(), value.encode()
        return (self._size(known + own) - self._size(known)) / len(own)


def spans_of(text: str, novelty: Novelty) -> list[Span]:
    """All spans of a text: the base ones, and candidates that are new."""
    base = base_spans(text)
    found = candidates(text, base)
    if not found:
        return base
    holes = sorted([*found, *((s.start, s.end) for s in base)])
    covered: list[tuple[int, int]] = []
    for a, b in holes:
        if covered and a <= covered[-1][1]:
            covered[-1] = (covered[-1][0], max(b, covered[-1][1]))
        else:
            covered.append((a, b))
    spans = list(base)
    for a, b in found:
        value = text[a:b]
        near = _without(text, b, b + AFTER, covered) + _without(text, max(0, a - BEFORE), a, covered)
        new = novelty(value, near.replace(value, ""))
        if new >= NOVEL:
            spans.append(Span("novel", a, b, a, new))
    return in_order(spans)


def identifier_dictionary(docs: DataFrame, most: int = DICTIONARY) -> bytes:
    """Identifiers of the lines with sensitive words, the most frequent last (nearest to the text).

    Documents are counted with partial sums before the shuffle; of the counts at most ``most`` / 5 rows
    are fetched, as an identifier has four letters at least.
    """
    lines = F.filter(
        F.split(F.col("text").cast("string"), "\n"),
        lambda line: line.rlike(f"(?i){SENSITIVE}"),
    )
    found = F.flatten(
        F.transform(lines, lambda line: F.regexp_extract_all(line, F.lit(_IDENTIFIER), F.lit(0)))
    )
    words = docs.where(F.col("text").cast("string").rlike(f"(?i){SENSITIVE}"))
    words = words.select(F.explode(F.array_distinct(found)).alias("word"))
    counts = words.groupBy("word").agg(F.count("*").alias("docs")).where("docs > 1")
    top = counts.orderBy(F.desc("docs"), "word").limit(most // 5).collect()
    chosen, size = [], 0
    for r in top:
        size += len(r["word"]) + 1
        if size > most:
            break
        chosen.append(r["word"])
    return " ".join(reversed(chosen)).encode()


def find_secrets(docs: DataFrame, identifiers: bytes | None = None) -> DataFrame:
    """``docs`` with ``spans`` of its ``text``: kind, start, end (code points), where the value
    begins, and the novelty of a novel one. One pass over the texts, no shuffle.
    """
    if identifiers is None:
        identifiers = identifier_dictionary(docs)
    known = docs.sparkSession.sparkContext.broadcast(identifiers)  # DICTIONARY bytes at most
    own = [f"`{c}`" for c in docs.columns if c != "spans"]
    rows = docs.select(*own).withColumn("text", F.col("text").cast("string"))
    schema = T.StructType([*rows.schema, T.StructField("spans", T.ArrayType(T._parse_datatype_string(SPAN)))])
    kind = pa.list_(
        pa.struct(
            [("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]
            + [("value_start", pa.int32()), ("novelty", pa.float64())]
        )
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        novelty = Novelty(known.value)
        for whole in batches:
            for batch in wd.slices(whole, "text"):
                found = [
                    [s._asdict() for s in spans_of(text.as_py() or "", novelty)]
                    for text in batch.column("text")
                ]
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(found, kind)], names=[*batch.schema.names, "spans"]
                )

    return rows.mapInArrow(run, schema)


def listed(spans: Column) -> Column:
    """Spans as ``kind:start:end``, comma-joined."""
    one = lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])
    return F.array_join(F.transform(spans, one), ",")


def of_kind(spans: Column, *kinds: str) -> Column:
    return F.filter(spans, lambda s: s["kind"].isin(*kinds))
