"""Secret scan by dictionary-primed zstandard novelty (9).

Three kinds of base patterns are always reported: assignments to a credential name, access keys, long hexadecimal
runs. Beyond them, strings near a sensitive word, on either side of it, are candidates; the word may be part of an
identifier or of the string itself. A candidate's novelty is the number of bytes that it adds to the compressed size
of the code around it, per character, where the compressor starts from a dictionary of common identifiers: words,
identifiers and copies of the surroundings cost few bytes, random strings cost nearly all of theirs. Candidates at
or over ``NOVELTY`` are reported as kind ``novel``, unless base spans cover them whole: a base span may end within a
secret, which is then reported beside it.

Offsets are code points of the original text, end exclusive. Results for special input: a null or empty text has
no spans; repeated rows are scanned each; texts of any length are scanned whole; an empty table gives no rows.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F, types as T

from platewise.llm.common import DOUBLE, LONG, STRING, carry, fields, pick, restore, slices

KINDS = ("assign", "access", "hex", "novel")
_ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]+")
MIN_ASSIGNED, MIN_ACCESS, MIN_HEX = 6, 20, 24
_HINTS = ("password", "passwd", "secret", "token", "api_key", "apikey")

#: Words beside which a string is looked at, also inside identifiers ("pass" only at the end of a part: no passenger),
#: and how many characters may lie between.
_SENSITIVE = re.compile(r"(?:pass(?:word|wd|phrase)|(?-i:[Pp]ass(?![a-z])|PASS(?![A-Za-z]))|pwd|secret|token|api[_ -]?key|"
                        r"private[_ -]?key|access[_ -]?key|credential|authorization|bearer|client[_ -]?id|signature|"
                        r"connection[_ -]?string)s?", re.I | re.A)
_SENSITIVE_HINTS = ("pass", "pwd", "secret", "token", "key", "credential", "authorization", "bearer", "client",
                    "signature", "connection")
REACH = 80
AROUND = 240
MIN_CANDIDATE = 16
_CANDIDATE = re.compile(r"[A-Za-z0-9+/_=.~!@#$%^&*-]{16,}")
_EQUALS = re.compile("=+")
_NAME = re.compile(r"[A-Za-z_./-]+").fullmatch
NOVELTY = 0.85
#: Identifiers and words of code, configuration and prose that a credential is often confused with.
IDENTIFIERS = " ".join("""
    password passwd secret token api_key apikey access_key private_key client_id client_secret credentials
    authorization bearer signature connection_string username user_name email address config configuration settings
    environment variable default example placeholder changeme your_password your_token_here undefined null true false
    public static final string integer boolean return function import export const class self this request response
    session cookie header content-type application/json charset=utf-8 http:// https:// www. .com .org .net .html .json
    localhost 127.0.0.1 0.0.0.0 version 1.0.0 2.0.0 update create delete select insert where table column index
    2020-01-01 2021-01-01 2022-01-01 2023-01-01 2024-01-01 2025-01-01 00:00:00 0123456789 abcdefghijklmnopqrstuvwxyz
    ABCDEFGHIJKLMNOPQRSTUVWXYZ
""".split())
_HEXADECIMAL = bytes(104 if c in b"0123456789abcdef" else 32 for c in range(256))


class Cover:
    """The union of spans, in order of start."""

    def __init__(self, spans: list[tuple]):
        self.starts, self.ends = [], []
        for a, _, b, _ in sorted(spans, key=lambda x: x[0]):
            if self.ends and a <= self.ends[-1]:
                self.ends[-1] = max(self.ends[-1], b)
            else:
                self.starts.append(a), self.ends.append(b)

    def holds(self, start: int, end: int) -> bool:
        k = bisect_right(self.starts, start) - 1
        return k >= 0 and end <= self.ends[k]

    def rest(self, start: int, end: int) -> list[tuple[int, int]]:
        """What the union leaves of a span that it meets; nothing of other spans."""
        a, b = bisect_right(self.ends, start), bisect_left(self.starts, end)
        cuts = zip([start, *self.ends[a:b]], [*self.starts[a:b], end])
        return [(c, d) for c, d in cuts if c < d] if a < b else []


class Scanner:
    """Built once per task: the compressor with its dictionary."""

    def __init__(self, novelty: float = NOVELTY):
        self.least = novelty
        given = zstandard.ZstdCompressionDict(IDENTIFIERS.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        self.packer = zstandard.ZstdCompressor(level=9, dict_data=given, write_checksum=False, write_content_size=False)

    def novelty(self, text: str, start: int, end: int) -> float:
        """Marginal compressed bytes per character of ``text[start:end]`` behind its surroundings."""
        around = (text[max(0, start - AROUND):start] + "\n" + text[end:end + AROUND]).encode()
        own = text[start:end].encode()
        return (len(self.packer.compress(around + b"\n" + own)) - len(self.packer.compress(around))) / (end - start)

    def base(self, text: str) -> list[tuple[int, int, int, float | None]]:
        """(start, kind, end, None) of the fixed patterns: leftmost matches, the failing ones dropped."""
        found = []
        low = text.lower()
        if any(h in low for h in _HINTS):
            found += [(m.start(), 0, m.end(), None) for m in _ASSIGN.finditer(text) if len(m[2]) >= MIN_ASSIGNED]
        if "AKIA" in text:
            found += [(m.start(), 1, m.end(), None) for m in _ACCESS.finditer(text) if len(m[0]) >= MIN_ACCESS]
        # a long run shows in the bytes first: one pass without a match per word
        if b"h" * MIN_HEX in text.encode().translate(_HEXADECIMAL):
            found += [(m.start(), 2, m.end(), None) for m in _HEX.finditer(text) if len(m[0]) >= MIN_HEX]
        return found

    def novel(self, text: str, start: int, end: int, words: list[tuple[int, int]]) -> list[tuple[int, int, float]]:
        """(start, end, novelty) of the novel parts of a string with the sensitive ``words`` in it.

        Without words: the string, else its parts between equals signs. With words: the value behind the first word's
        equals sign and what stands around the word, else the parts between words and equals signs, else all of it;
        there letters alone are the rest of the word's own identifier."""
        cuts = sorted(words + [m.span() for m in _EQUALS.finditer(text, start, end)])
        parts = list(zip([start, *(b for _, b in cuts)], [*(a for a, _ in cuts), end]))
        if words:
            first, behind = words[0]
            sign = _EQUALS.search(text, behind, end)
            name, value = sign.span() if sign else (end, end)
            loose = len(words) == 1 or words[-1][1] <= value  # no word in the value
            own = end - start - sum(b - a for a, b in words)
            tries = [[(value, end), (behind, name), (start, first)], parts, [(start, end)] if own >= MIN_CANDIDATE else []]
        else:
            value, loose = start, True
            tries = [[(start, end)], parts if cuts else []]
        for spans in tries:
            found = []
            for a, b in spans:
                if b - a >= MIN_CANDIDATE and (loose and a >= value or not _NAME(text, a, b)) and \
                        (new := self.novelty(text, a, b)) >= self.least:
                    found.append((a, b, new))
            if found:
                return found
        return []

    def scan(self, text: str) -> list[tuple[int, int, int, float | None]]:
        """(start, kind number, end, novelty) in order."""
        base = self.base(text)
        found, low = list(base), text.lower()
        if any(h in low for h in _SENSITIVE_HINTS) and (words := [m.span() for m in _SENSITIVE.finditer(text)]):
            starts, ends = [a for a, _ in words], [b for _, b in words]
            known = Cover(base)
            for m in _CANDIDATE.finditer(text):
                a, b = m.span()
                # the words that end at most REACH before the string or start at most REACH behind it
                near = range(bisect_left(ends, a - REACH), bisect_right(starts, b + REACH))
                if near and not known.holds(a, b):
                    # where the base spans dilute the whole: what they leave, except names
                    for spans in ([(a, b)], [r for r in known.rest(a, b) if not _NAME(text, *r)]):
                        new = [x for c, d in spans
                               for x in self.novel(text, c, d, words[bisect_right(ends, c):bisect_left(starts, d)])]
                        if new := [(c, 3, d, x) for c, d, x in new if not known.holds(c, d)]:
                            found += new
                            break
        return sorted(found, key=lambda x: x[:3])


OUT = T.StructType([T.StructField("secrets", T.ArrayType(fields(kind=STRING, start=LONG, end=LONG, novelty=DOUBLE)))])


def find_secrets(docs: DataFrame, novelty: float = NOVELTY) -> DataFrame:
    """``docs`` with ``secrets``: kind, start, end and, for novel strings, their novelty; a column of that name is
    replaced."""
    source = carry(docs, "text").withColumn("text", F.col("text").cast("string"))
    schema = T.StructType([source.schema["row"], *OUT.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(novelty)
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()),
                                   ("novelty", pa.float64())]))
        for whole in batches:
            for batch in slices(whole, "text"):
                found = [[{"kind": KINDS[k], "start": a, "end": b, "novelty": x} for a, k, b, x in scanner.scan(t or "")]
                         for t in batch.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(found, kind)], names=["row", "secrets"])

    return restore(source.mapInArrow(run, schema), docs, "secrets")


def masked(text: str | None, spans: list[tuple[int, int]], mark: str) -> str | None:
    """``text`` with its spans (in order of start; overlapping ones as one) replaced by ``mark``."""
    out, at, end = [], 0, 0
    for a, b in spans:
        if a >= end:
            out += [text[at:a], mark]
        end = at = max(end, b)
    return "".join(out) + text[at:] if spans else text


def redact(docs: DataFrame, mark: str = "[SECRET]", novelty: float = NOVELTY) -> DataFrame:
    """``docs`` with every secret in ``text`` replaced by ``mark``; ``n_chars``, where there is such a column, is the
    new length of a changed text. All rows and other columns stay as they are."""
    source = carry(docs, "text").withColumn("text", F.col("text").cast("string"))
    schema = T.StructType([source.schema["row"], *fields(text=STRING, changed=LONG).fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(novelty)
        for whole in batches:
            for batch in slices(whole, "text"):
                texts = batch.column("text").to_pylist()
                spans = [[(a, b) for a, _, b, _ in scanner.scan(t or "")] for t in texts]
                new = [masked(t, s, mark) for t, s in zip(texts, spans)]
                size = [len(n) if s else None for n, s in zip(new, spans)]
                yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(new, pa.string()), pa.array(size, pa.int64())],
                                                 names=schema.names)

    done = source.mapInArrow(run, schema)
    return done.select(*[
        (F.col("text") if k == docs.columns.index("text") else
         F.coalesce(F.col("changed").cast(f.dataType), F.col(f"row._c{k}")) if f.name == "n_chars" else F.col(f"row._c{k}")).alias(f.name)
        for k, f in enumerate(docs.schema.fields)])


def digest(found: DataFrame) -> DataFrame:
    """The operator's rows as the registered query returns them (spans are in order of start, then kind)."""
    base = F.filter("secrets", lambda x: x["kind"] != "novel")
    line = lambda spans: F.array_join(F.transform(spans, lambda x: F.concat_ws(
        ":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")
    count = lambda kind: F.size(F.filter("secrets", lambda x: x["kind"] == kind)).cast("long")
    return found.select("doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"),
                        count("hex").alias("n_hex"), F.sha2(line(base).cast("binary"), 256).alias("base_sha256"),
                        line(F.col("secrets")).alias("spans"))


def scan_documents(docs: DataFrame) -> DataFrame:
    return digest(find_secrets(pick(docs, "doc_id", "text")))
