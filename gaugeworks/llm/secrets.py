"""Secret scans that link the parts of a credential.

Strong kinds are reported wherever they stand: assignments of a named secret, access key ids, and
long runs of hex digits. Weak candidates say little alone: account identifiers, values of short
secret names and mixed random tokens, and endpoints. They are joined as intervals inside their
scope (a run of lines without an empty line between), with ``REACH`` code points at most from the
end of one to the start of the other; a weak candidate is reported only when complementary parts
stand there: a secret with an identifier or an endpoint. Names may have a prefix that ends in an
underscore (``DB_USER``). Strong spans take part in the join. The work is linear in the text:
candidates are sorted and the join looks them up by position.

Positions are code points, ends exclusive. Null and empty texts have no spans. Repeated rows and
ids get a row each.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeworks.llm.common import pieces, query, table
from gaugeworks.llm.tokens import LOWER, buffers

MASK = "[SECRET]"

#: Kinds in the order in which spans of one start are listed. Fixed values.
KINDS = ("assign", "access", "hex", "identifier", "secret", "endpoint")

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
# From the start of a word, so that each word is tried once.
PREFIX = r"(?<![A-Za-z0-9_])(?:[A-Za-z0-9]*+_)*"
WEAK = {
    "identifier": re.compile(
        PREFIX + r"""(?:user(?:name|_?id)?|login|account(?:_?id)?|client_?id|access_?key(?:_?id)?|email)["']?\x20*[:=]\x20*["']?([^\s"',;]{3,})""",
        re.I | re.A,
    ),
    "secret": re.compile(
        PREFIX + r"""(?:pwd|pass|pw|passphrase|private_?key|credentials?|auth(?:orization)?|bearer|access_?key|client_?secret)["']?\x20*[:=]\x20*["']?([^\s"',;]{6,})"""
        r"""|(?<![A-Za-z0-9+/_-])(?=[A-Za-z0-9+/_-]*[0-9])(?=[A-Za-z0-9+/_-]*[a-z])(?=[A-Za-z0-9+/_-]*[A-Z])([A-Za-z0-9+/_-]{20,})(?![A-Za-z0-9+/_-])""",
        re.I | re.A,
    ),
    "endpoint": re.compile(
        r"""\b(?:https?|jdbc:[a-z0-9]+|postgres(?:ql)?|mysql|mongodb(?:\+srv)?|redis|amqps?|s3|ftp|ssh)://[^\s"'<>]+"""
        "|" + PREFIX + r"""(?:host(?:name)?|server|endpoint|url|region|bucket)["']?\x20*[:=]\x20*["']?[^\s"',;]{3,}"""
        r"""|\b[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?::[0-9]{2,5})?\b""",
        re.I | re.A,
    ),
}
#: Sides that complement a weak span.
PARTNERS = {"secret": ("identifier", "endpoint"), "identifier": ("secret",), "endpoint": ("secret",)}
# The random-token part must tell cases apart.
TOKEN = re.compile(r"(?=[^\s]*[0-9])(?=[^\s]*[a-z])(?=[^\s]*[A-Z])")
NAMED = (b"passw", b"secret", b"token", b"apikey", b"api_key")
SIGNS = (b":", b"=")
LONG_HEX = re.compile(rb"[0-9a-f]{32}")
RANDOM = re.compile(rb"[A-Za-z0-9+/_-]{20}")
EMPTY_LINE = re.compile(r"\n[ \t\r]*\n")

Span = tuple[str, int, int, int]  #: kind, start, end, start of the value


def base_spans(text: str, low: bytes) -> list[Span]:
    """Strong spans. ``low`` is the text's UTF-8 in lower case, to see quickly what it lacks."""
    found: list[Span] = []
    if any(x in low for x in NAMED):
        found += [("assign", m.start(), m.end(), m.start(2)) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    if b"akia" in low:
        found += [("access", m.start(), m.end(), m.start()) for m in ACCESS.finditer(text) if len(m[0]) >= 16]
    if LONG_HEX.search(low):
        found += [("hex", m.start(), m.end(), m.start()) for m in HEX.finditer(text) if len(m[0]) >= 32]
    return found


def weak_spans(text: str) -> list[Span]:
    found: list[Span] = []
    for kind, pattern in WEAK.items():
        for m in pattern.finditer(text):
            group = m.lastindex or 0
            if kind == "secret" and group == 2 and not TOKEN.match(m[2]):
                continue
            found.append((kind, m.start(), m.end(), m.start(group)))
    return found


def _covered(base: list[Span]) -> list[list[int]]:
    """The ranges that strong spans cover, in order and apart."""
    out: list[list[int]] = []
    for _, start, end, _ in sorted(base, key=lambda s: s[1]):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return out


def linked(text: str, base: list[Span]) -> list[Span]:
    """Weak spans that have a complementary part in their scope, apart from them.

    Spans hold no line ends, so each lies in one scope. Some part of a side is apart from a span
    just when the side's last start is not before the span's end, or its first end not behind
    the span's start.
    """
    weak = weak_spans(text)
    if not weak:
        return []
    covered = _covered(base)
    starts = [c[0] for c in covered]
    free = []
    for s in weak:  # what a strong span covers is reported already
        k = bisect_left(starts, s[2])
        if not (k and covered[k - 1][1] > s[1]):
            free.append(s)
    cuts = [m.start() for m in EMPTY_LINE.finditer(text)]
    ends: dict[tuple[int, str], tuple[int, int]] = {}  # of scope and side: first end, last start
    for kind, start, end, _ in base + free:
        side = {"assign": "secret", "hex": "secret", "access": "identifier"}.get(kind, kind)
        at = (bisect_right(cuts, start), side)
        first, last = ends.get(at, (end, start))
        ends[at] = (min(first, end), max(last, start))

    def has(s: Span) -> bool:
        scope = bisect_right(cuts, s[1])
        parts = (ends.get((scope, side)) for side in PARTNERS[s[0]])
        return any(p is not None and (p[1] >= s[2] or p[0] <= s[1]) for p in parts)

    return [s for s in free if has(s)]


def scan(text: str, low: bytes) -> tuple[list[Span], list[Span]]:
    """Base spans, and all spans, each by start and then kind."""
    base = base_spans(text, low)
    more = []
    if any(x in low for x in SIGNS) or RANDOM.search(low):
        more = linked(text, base)
    order = lambda s: (s[1], KINDS.index(s[0]), s[2])
    return sorted(base, key=order), sorted(base + more, key=order)


def _texts(column: pa.Array):
    raw, offsets = buffers(column)
    low = LOWER[raw].tobytes()
    for i, text in enumerate(column.to_pylist()):
        yield text or "", low[offsets[i] : offsets[i + 1]]


def _listed(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b, _ in spans)


def _report(batches):
    for batch in pieces(batches):
        rows = []
        for text, low in _texts(batch.column("text")):
            base, spans = scan(text, low)
            count = [sum(s[0] == k for s in base) for k in KINDS[:3]]
            rows.append((*count, len(spans) - len(base), _listed(base), _listed(spans)))
        columns = list(zip(*rows, strict=True))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *[pa.array(c, pa.int64()) for c in columns[:4]], *[pa.array(c, pa.string()) for c in columns[4:]]],
            ["doc_id", "n_assign", "n_access", "n_hex", "n_linked", "base", "spans"],
        )


def secret_spans(docs: DataFrame) -> DataFrame:
    """(doc_id, text) to counts of each strong kind, linked weak spans, and both span lists."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(
        _report, "doc_id long, n_assign long, n_access long, n_hex long, n_linked long, base string, spans string"
    )


def masked(text: str, spans: list[Span], mask: str = MASK) -> str:
    """The text with each span's value replaced; overlapping values become one mask."""
    out, at = [], 0
    values = sorted((v, end) for _, _, end, v in spans)
    merged: list[list[int]] = []
    for a, b in values:
        if merged and a < merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], b)
        else:
            merged.append([a, b])
    for a, b in merged:
        out += (text[at:a], mask)
        at = b
    return "".join(out) + text[at:]


def _mask(batches):
    for batch in pieces(batches, "gw_text"):
        texts = []
        for text, low in _texts(batch.column("gw_text")):
            spans = scan(text, low)[1]
            texts.append(masked(text, spans) if spans else None)
        names = batch.schema.names
        yield pa.RecordBatch.from_arrays(
            [pa.array(texts, pa.string()) if n == "gw_text" else batch.column(n) for n in names], names
        )


def mask_secrets(docs: DataFrame) -> DataFrame:
    """``docs``, all rows and columns, with secret values masked and ``n_chars`` following."""
    rows = docs.select(F.struct("*").alias("gw_row"), F.col("text").cast("string").alias("gw_text"))
    done = rows.mapInArrow(_mask, rows.schema)
    changed = F.col("gw_text").isNotNull()
    return done.select(
        *[
            F.coalesce("gw_text", "gw_row.text").alias(c) if c == "text"
            else F.when(changed, F.length("gw_text")).otherwise(F.col("gw_row.n_chars")).cast(docs.schema[c].dataType).alias(c) if c == "n_chars"
            else F.col(f"gw_row.`{c}`").alias(c)
            for c in docs.columns
        ]
    )


@query("op7_secrets")
def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents. Positions of matches are beyond SQL; tests hold it against plain code."""
    found = secret_spans(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_assign", "n_access", "n_hex", "n_linked", F.sha2("base", 256).alias("base_sha256"), "spans"
    )
