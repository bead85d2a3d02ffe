"""Secret scans: fixed patterns, and character runs whose local entropy is that of keys.

Patterns give the kinds `assign`, `access` and `hex`, matched from the left without overlap,
each kind by itself. The entropy scan looks at runs of one character class: a window slides
along the run, the counts of its characters change by two per step, and so does the sum from
which Shannon's entropy follows. Windows at or above the class's bound are joined to spans of
the kind `entropy_hex` or `entropy_base64`. Spans that an allow-list names, or that lie within
a pattern's span, are suppressed; patterns are never suppressed.

Offsets are code points, the end is exclusive. Null and empty texts have no spans; texts of
any length are scanned whole; repeated rows give repeated rows; an empty table gives none.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyrisk.llm.texts import per_text

# The patterns, and the least lengths of what they capture.
KINDS = ("assign", "access", "hex", "entropy_hex", "entropy_base64")
ASSIGN = re.compile(r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "api")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")  # whole runs, as they are matched greedily
LEAST_ASSIGNED, LEAST_ACCESS, LEAST_HEX = 6, 20, 24

# Well-known strings that look like keys but are public by nature.
ALLOWED = (
    r"[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}",  # identifiers
    r"sha(?:1|256|384|512)-?[A-Za-z0-9+/]*",  # integrity values
    r"[A-Z]*[a-z]+(?:[-_/][A-Za-z]+)*",  # words, paths of words
    r"[0-9]+(?:[-_/][0-9]+)*",  # numbers, dates
    r"(?:.*)EXAMPLE(?:KEY)?",  # documentation samples
)


@dataclass(frozen=True)
class CharClass:
    """Runs of one class: least length is the window, `least` the entropy in bits."""

    name: str
    characters: str
    window: int
    least: float
    runs: re.Pattern = field(init=False, repr=False, compare=False)

    def __post_init__(self) -> None:
        pattern = rf"(?<![{self.characters}])[{self.characters}]{{{self.window},}}"
        object.__setattr__(self, "runs", re.compile(pattern))


CLASSES = (
    CharClass("entropy_hex", "0-9a-fA-F", 32, 3.3),
    CharClass("entropy_base64", r"A-Za-z0-9+/_\-", 24, 3.9),
)


def entropies(run: str, window: int) -> list[float]:
    """Entropy in bits of every window of a run, by incremental counts."""
    weigh = [0.0, *(c * math.log2(c) for c in range(1, window + 1))]
    counts = Counter(run[:window])
    total = sum(weigh[c] for c in counts.values())
    out = [math.log2(window) - total / window]
    for gone, came in zip(run, run[window:], strict=False):
        if gone != came:
            c, d = counts[gone], counts[came]
            total += weigh[c - 1] - weigh[c] + weigh[d + 1] - weigh[d]
            counts[gone], counts[came] = c - 1, d + 1
        out.append(math.log2(window) - total / window)
    return out


def _mixed(run: str) -> bool:
    """Keys mix digits with letters; long words and numbers do not."""
    return any(c.isdigit() for c in run) and any(c.isalpha() for c in run)


def dense_spans(text: str, kind: CharClass, allowed: re.Pattern) -> list[tuple[int, int]]:
    """Joined windows of high entropy in the runs of one class."""
    out: list[tuple[int, int]] = []
    for m in kind.runs.finditer(text):
        run = m.group()
        if not _mixed(run) or allowed.fullmatch(run):
            continue
        for i, bits in enumerate(entropies(run, kind.window)):
            if bits >= kind.least:
                a, b = m.start() + i, m.start() + i + kind.window
                if out and a <= out[-1][1]:
                    out[-1] = (out[-1][0], b)
                else:
                    out.append((a, b))
    return out


def find(text: str, allowed: re.Pattern, classes: tuple[CharClass, ...] = CLASSES) -> list[tuple[str, int, int]]:
    """Spans (kind, start, end) of one text, by start, then by kind as listed."""
    found = []
    low = text.lower()  # only to rule texts out: ASCII letters survive it in one case
    if any(w in low for w in ASSIGN_WORDS):
        found += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m.group(2)) >= LEAST_ASSIGNED]
    if "AKIA" in text:
        found += [("access", *m.span()) for m in ACCESS.finditer(text) if len(m.group()) >= LEAST_ACCESS]
    longest = max(map(len, text.split()), default=0)
    if longest >= LEAST_HEX:
        found += [("hex", *m.span()) for m in HEX.finditer(text)]
    base = list(found)
    for kind in classes:
        if longest >= kind.window:
            for a, b in dense_spans(text, kind, allowed):
                if not any(s <= a and b <= e for _, s, e in base):
                    found.append((kind.name, a, b))
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def scan(df: DataFrame, key: str = "doc_id", text: str = "text", allow: tuple[str, ...] = ALLOWED) -> DataFrame:
    """key, findings (array of kind, start, end) of every row."""

    def rows(texts: list[str]) -> dict:
        allowed = re.compile("|".join(f"(?:{a})" for a in allow) or r"(?!)")
        found = [[{"kind": k, "start": a, "end": b} for k, a, b in find(t, allowed)] for t in texts]
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        return {"findings": pa.array(found, kind)}

    return per_text(df, key, text, "findings array<struct<kind:string,start:long,end:long>>", rows)


def joined(findings: Column) -> Column:
    """kind:start:end of findings, comma-joined in their order."""
    return F.array_join(F.transform(findings, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def digests(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, counts and digest of the pattern spans, and all spans as one string."""
    of = lambda *kinds: F.filter("findings", lambda x: x["kind"].isin(*kinds))
    base = KINDS[:3]
    return scan(df, key, text).select(
        key,
        *[F.size(of(k)).cast("long").alias(f"n_{k}") for k in base],
        F.sha2(joined(of(*base)), 256).alias("base_sha256"),
        joined(F.col("findings")).alias("spans"),
        (F.size("findings") - F.size(of(*base))).cast("long").alias("n_entropy"),
    )


def redact(df: DataFrame, text: str = "text", allow: tuple[str, ...] = ALLOWED) -> DataFrame:
    """The same rows and columns with every span replaced by [kind]; overlapping spans are
    replaced together, under the kind of the first. Null texts stay null."""

    def covered(value: str, allowed: re.Pattern) -> str:
        out, at = [], 0
        for kind, a, b in find(value, allowed):
            if a >= at:
                out += [value[at:a], f"[{kind}]"]
            at = max(at, b)
        return "".join([*out, value[at:]]) if out else value

    def run(batches):
        allowed = re.compile("|".join(f"(?:{a})" for a in allow) or r"(?!)")
        for batch in batches:
            i = batch.schema.get_field_index(text)
            clean = [None if t is None else covered(t, allowed) for t in batch.column(i).to_pylist()]
            yield batch.set_column(i, text, pa.array(clean, batch.schema.field(i).type))

    return df.mapInArrow(run, df.schema)
