"""SentencePiece encoding and decoding for merge-type (BPE) vocabularies.

Encoding. The normalised text is cut where no vocabulary piece can reach across, each cut
part is merged by an agenda of adjacent symbol pairs ordered by (score, position), and
characters without a piece become byte pieces. Parts that a task meets for the first time
are encoded by the sentencepiece library as well, batch by batch; a difference stops the
job. The cuts themselves are not checked: no whole text is encoded by the library. Decoding
joins pieces and bytes again; where that does not give the text back, the library decodes too.

Cases: null and empty texts give the begin and end ids only; texts of any length are
encoded whole (memory follows the longest text of a batch); repeated rows give repeated
rows; an empty table gives no rows. Columns other than the key and the text are ignored,
whatever their names.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyrisk.llm.texts import per_text

SPACE = "▁"  # the library's mark for a space
CACHE_PARTS = 600_000  # remembered parts per task; forgotten together, never wrong
CACHE_LENGTH = 64  # longer parts are not remembered


class Codec:
    """Encodes and decodes with the pieces and scores of a BPE model file."""

    def __init__(self, model: str) -> None:
        import sentencepiece

        self.library = lib = sentencepiece.SentencePieceProcessor(model_file=model)
        ids = range(lib.get_piece_size())
        special = lambda i: lib.is_control(i) or lib.is_unknown(i) or lib.is_unused(i) or lib.is_byte(i)
        self.piece = [lib.id_to_piece(i) for i in ids]
        self.bytes = {i: int(self.piece[i][3:-1], 16) for i in ids if lib.is_byte(i)}
        # What each piece shows; bytes above ASCII depend on their neighbours.
        self.shown = ["" if lib.is_control(i) else chr(self.bytes[i]) if i in self.bytes else self.piece[i] for i in ids]
        self.shown[lib.unk_id()] = lib.decode([lib.unk_id()])
        self.high = {i for i, b in self.bytes.items() if b > 127}
        self.byte_ids = [i for i, _ in sorted(self.bytes.items(), key=lambda x: x[1])]
        self.ids = {self.piece[i]: i for i in ids if not special(i)}
        # Agenda order: the higher score first.
        self.rank = {p: -lib.get_score(i) for p, i in self.ids.items()}
        self.begin, self.end = lib.bos_id(), lib.eos_id()
        self._assert_supported()
        self.cuts = re.compile(self._pattern())
        self.known: dict[str, bytes] = {}  # little-endian 32-bit ids

    def _assert_supported(self) -> None:
        """The text itself must be the normal form, but for spaces and the first mark."""
        for text in (" a  b ", "ﬁ ①　xéé", "\t\n\r\x00", "Aa"):
            if self.library.normalize(text) != SPACE + text.replace(" ", SPACE):
                raise ValueError("the model normalises texts; only identity models are supported")
        if len(self.byte_ids) != 256:
            raise ValueError("the model has no byte fallback")

    def _pattern(self) -> str:
        """Parts that no piece can join: a mark starts a part, and so does a sign behind a
        letter, for the signs that no piece holds there; characters that no longer piece
        holds stand alone."""
        longer = [p for p in self.ids if len(p) > 1]
        behind: dict[str, set[str]] = {}
        for p in longer:
            for a, b in zip(p, p[1:], strict=False):
                behind.setdefault(b, set()).add(a)
        if behind.get(SPACE, set()) - {SPACE}:
            raise ValueError("a piece holds a mark behind other characters")
        held = {c for p in longer for c in p}
        alone = {c for c in "\n\t\r" if c not in held}
        signs = {c for c in ".,!?;:|%$&*#" if c not in alone and not any(a.isalpha() for a in behind.get(c, ()))}
        group = lambda *cs: re.escape("".join(sorted(set().union(*cs))))
        letter, edge = r"[^\W\d_]", SPACE + group(alone)
        other, inner = rf"(?:[^\w{edge}]|[\d_])", rf"(?:[^\w{edge}{group(signs)}]|[\d_])"
        word = f"{letter}*(?:{inner}{other}*{letter}*)*"
        return (f"[{group(alone)}]|" if alone else "") + f"{SPACE}+{other}*{word}|{other}+{word}|{letter}+(?:{inner}{other}*{letter}*)*"

    def merge(self, part: str) -> tuple[int, ...]:
        """Ids of one part: take the best adjacent pair, the leftmost of equals, join it and
        offer its new neighbours. Short parts keep the agenda in a list, long ones in a heap."""
        symbols = self._merge_short(part) if len(part) <= 32 else self._merge_long(part)
        out: list[int] = []
        for s in symbols:
            i = self.ids.get(s)
            if i is None:
                out += [self.byte_ids[b] for b in s.encode()]
            else:
                out.append(i)
        return tuple(out)

    def _merge_short(self, part: str) -> list[str]:
        rank, never = self.rank.get, float("inf")
        symbols = list(part)
        agenda = [rank(a + b, never) for a, b in zip(symbols, symbols[1:], strict=False)]
        while agenda and (best := min(agenda)) < never:
            i = agenda.index(best)
            symbols[i] += symbols.pop(i + 1)
            del agenda[i]
            if i < len(agenda):
                agenda[i] = rank(symbols[i] + symbols[i + 1], never)
            if i:
                agenda[i - 1] = rank(symbols[i - 1] + symbols[i], never)
        return symbols

    def _merge_long(self, part: str) -> list[str]:
        rank = self.rank
        symbols, n = list(part), len(part)
        agenda = [(rank[p], i, i + 1, p) for i in range(n - 1) if (p := part[i : i + 2]) in rank]
        heapify(agenda)
        left, right = list(range(-1, n - 1)), list(range(1, n + 1))
        while agenda:
            _, i, j, pair = heappop(agenda)
            # A pair is stale once either of its symbols was joined elsewhere.
            if right[i] != j or not symbols[i] or symbols[i] + symbols[j] != pair:
                continue
            symbols[i], symbols[j] = pair, ""
            after = right[i] = right[j]
            if after < n:
                left[after] = i
                if (new := pair + symbols[after]) in rank:
                    heappush(agenda, (rank[new], i, after, new))
            before = left[i]
            if before >= 0 and (new := symbols[before] + pair) in rank:
                heappush(agenda, (rank[new], before, i, new))
        return [s for s in symbols if s]

    def check_parts(self, parts: list[str]) -> None:
        """Compare parts with the library, each behind a line break, which it cannot join."""
        texts = ["\n" + p.replace(SPACE, " ") for p in parts]
        head = len(self.merge(SPACE)) + len(self.merge("\n"))
        for part, ids in zip(parts, self.library.encode(texts, num_threads=1), strict=True):
            if _packed(ids[head:]) != self.known[part]:
                raise ValueError(f"the agenda and the library differ on {part!r}")

    def encode(self, texts: Iterable[str]) -> list[np.ndarray]:
        """Ids of whole texts with begin and end ids."""
        cut = [self.cuts.findall(SPACE + t.replace(" ", SPACE)) if t else [] for t in texts]
        known = self.known
        if len(known) > CACHE_PARTS:
            known.clear()
        new = list({p for parts in cut for p in parts if p not in known})
        for p in new:
            known[p] = _packed(self.merge(p))
        if new:
            self.check_parts(new)
        begin, end = _packed([self.begin]), _packed([self.end])
        out = [np.frombuffer(b"".join([begin, *map(known.__getitem__, parts), end]), "<u4") for parts in cut]
        for p in new:
            if len(p) > CACHE_LENGTH:
                del known[p]
        return out

    def decode(self, ids: list[int]) -> str:
        """Text of ids: neighbouring byte pieces are read together as UTF-8, wrong bytes
        become the replacement character, and the first mark goes."""
        if self.high.isdisjoint(ids):
            text = "".join(map(self.shown.__getitem__, ids))
        else:
            out, raw = [], bytearray()
            for i in ids:
                if i in self.bytes:
                    raw.append(self.bytes[i])
                    continue
                out += [_utf8(raw), self.shown[i]]
                raw.clear()
            text = "".join([*out, _utf8(raw)])
        return text.removeprefix(SPACE).replace(SPACE, " ")


def _packed(ids: Iterable[int]) -> bytes:
    return array("I", ids).tobytes()


def _utf8(raw: bytearray) -> str:
    """The library puts one replacement character for each byte that is not UTF-8."""
    try:
        return raw.decode()
    except UnicodeDecodeError:
        out, at = [], 0
        while at < len(raw):
            for n in (1, 2, 3, 4):
                try:
                    out.append(raw[at : at + n].decode())
                    at += n
                    break
                except UnicodeDecodeError:
                    continue
            else:
                out.append("�")
                at += 1
        return "".join(out)


@lru_cache(maxsize=4)
def codec(model: str) -> Codec:
    """One codec per Python worker and model file."""
    return Codec(model)


def encode_decode(df: DataFrame, model: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, ids (with begin and end) and the decoded text of every row."""

    def rows(texts: list[str]) -> dict:
        c = codec(model)
        packed = c.encode(texts)
        ids = [i.tolist() for i in packed]
        decoded = [c.decode(i) for i in ids]
        # Texts that decoding does not give back are settled with the library.
        for i, t, d in zip(ids, texts, decoded, strict=True):
            if t != d and c.library.decode(i) != d:
                raise ValueError("decoding and the library differ")
        edges = np.cumsum([0, *map(len, packed)], dtype=np.int32)
        flat = pa.array(np.concatenate(packed).astype(np.int32))
        return {"ids": pa.ListArray.from_arrays(edges, flat), "decoded": pa.array(decoded, pa.string())}

    return per_text(df, key, text, "ids array<int>, decoded string", rows)


def token_digests(df: DataFrame, model: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n_tokens, ids_sha256 (little-endian unsigned 32-bit ids), decoded_sha256."""

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sha = lambda b: hashlib.sha256(b).hexdigest()
        for batch in batches:
            ids = [np.asarray(i.values, "<u4") for i in batch.column(1)]
            yield pa.RecordBatch.from_pydict(
                {
                    key: batch.column(0),
                    "n_tokens": pa.array([len(i) for i in ids], pa.int64()),
                    "ids_sha256": [sha(i.tobytes()) for i in ids],
                    "decoded_sha256": [sha(d.as_buffer()) for d in batch.column(2)],
                }
            )

    key_type = df.schema[key].dataType.simpleString()
    schema = f"{key} {key_type}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return encode_decode(df, model, key, text).mapInArrow(digests, schema)


def token_rows(df: DataFrame, model: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n_tokens, ids, decoded_sha256 of every row."""
    return encode_decode(df, model, key, text).select(
        key, F.size("ids").cast("long").alias("n_tokens"), "ids", F.sha2("decoded", 256).alias("decoded_sha256")
    )
