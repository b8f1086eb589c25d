"""Fill-in-the-middle by piece tables.

A document is never cut as a string. It is a list of descriptors (buffer, start,
length) over immutable buffers: buffer 0 holds the sentinels, buffer 1 the bytes
of a batch of texts. Cutting after a number of code points splits the descriptor
that holds the cut in two; an arrangement permutes the three parts and puts a
sentinel descriptor before each; hashes and output files stream the descriptors'
bytes in order. Restoring starts from the output alone: its bytes are one
descriptor, split at the sentinels, the sentinels dropped and the parts put back
by the inverse permutation.

``plan`` fixes the cuts and the form of a document from sha256 of its id (fixed
rule): prefix and middle end after the smaller and the larger of h1 mod (n+1) and
h2 mod (n+1) code points; plain if the text is empty, holds a sentinel or
h3 mod 100 >= 90; else spm if h4 mod 100 < 20, else psm.

Each row is worked on alone (no shuffle), in batches of about 2 MB; a longer text
is a batch of its own. Defined results: a null text is empty and plain; a null id
reads as the text ''; repeated rows give repeated results; other columns are not
looked at; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowscope.llm.common import map_arrow, string_bytes, text_or_empty

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"  # fixed values
SENTINELS = b"".join((PREFIX, SUFFIX, MIDDLE))
# form -> order of the parts (0 prefix, 1 middle, 2 suffix) in the output, each behind its sentinel
ORDERS = {"psm": (0, 2, 1), "spm": (2, 0, 1)}
MARKS = {0: PREFIX, 1: MIDDLE, 2: SUFFIX}
PLAIN_FROM, SPM_BELOW = 90, 20
_COUNT_STEP = 1 << 16

Descriptor = tuple[int, int, int]  # buffer, start, length in bytes


class Pieces:
    """A sequence of descriptors over shared buffers that nothing writes to."""

    __slots__ = ("buffers", "table")

    def __init__(self, buffers: tuple, table: list[Descriptor]):
        self.buffers, self.table = buffers, table

    def cut(self, offsets: list[int]) -> list[Pieces]:
        """The parts between ascending byte ``offsets``; descriptors split, bytes stay where they are."""
        parts, rest = [], list(reversed(self.table))
        done = 0
        for end in offsets:
            mine = []
            while done < end:
                b, s, n = rest.pop()
                take = min(n, end - done)
                mine.append((b, s, take))
                if take < n:
                    rest.append((b, s + take, n - take))
                done += take
            parts.append(Pieces(self.buffers, mine))
        parts.append(Pieces(self.buffers, rest[::-1]))
        return parts

    def __add__(self, other: Pieces) -> Pieces:
        return Pieces(self.buffers, self.table + other.table)

    def chunks(self) -> Iterator[memoryview]:
        for b, s, n in self.table:
            yield self.buffers[b][s: s + n]

    def sha256(self) -> str:
        h = hashlib.sha256()
        for c in self.chunks():
            h.update(c)
        return h.hexdigest()

    def tobytes(self) -> bytes:
        return b"".join(self.chunks())


def byte_offsets(text: memoryview, points: list[int]) -> list[int]:
    """Byte offsets of ascending code point positions of a UTF-8 text."""
    if not any(points):
        return [0] * len(points)
    raw, out, seen = np.frombuffer(text, np.uint8), [], 0
    want = iter(points)
    nxt = next(want, None)
    for at in range(0, len(raw), _COUNT_STEP):
        starts = np.flatnonzero((raw[at: at + _COUNT_STEP] & 0xC0) != 0x80)
        while nxt is not None and nxt < seen + len(starts):
            out.append(at + int(starts[nxt - seen]))
            nxt = next(want, None)
        seen += len(starts)
    return out + [len(raw)] * (len(points) - len(out))


def code_points(text: memoryview) -> int:
    raw = np.frombuffer(text, np.uint8)
    return sum(int(np.count_nonzero((raw[a: a + _COUNT_STEP] & 0xC0) != 0x80)) for a in range(0, len(raw), _COUNT_STEP))


def plan(doc_id: int | None, n: int, marked: bool) -> tuple[str, int, int]:
    """(form, code points before the middle, code points before the suffix) of a text of ``n``
    code points; ``marked``: it holds a sentinel."""
    digest = hashlib.sha256(b"1:" + (b"" if doc_id is None else str(doc_id).encode())).digest()
    h1, h2, h3, h4 = (int.from_bytes(digest[i: i + 4], "big") for i in range(0, 16, 4))
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if n == 0 or marked or h3 % 100 >= PLAIN_FROM:
        return "plain", a, b
    return ("spm" if h4 % 100 < SPM_BELOW else "psm"), a, b


def arrange(document: Pieces, form: str, cuts: list[int]) -> Pieces:
    """The output of a document: its parts in the order of ``form``, each behind its sentinel."""
    if form == "plain":
        return document
    parts = document.cut(cuts)
    out = Pieces(document.buffers, [])
    for k in ORDERS[form]:
        mark = Pieces(document.buffers, [(0, SENTINELS.index(MARKS[k]), len(MARKS[k]))])
        out = out + mark + parts[k]
    return out


def restore(output: bytes | memoryview, form: str) -> Pieces:
    """The document that ``arrange`` made ``output`` of, as pieces of the output's own bytes."""
    whole = Pieces((memoryview(output),), [(0, 0, len(output))])
    if form == "plain":
        return whole
    data, at, parts = bytes(output) if isinstance(output, memoryview) else output, 0, {}
    cuts, order = [], ORDERS[form]
    for k in order:  # a text of this form holds no sentinel: the first one found is the right one
        at = data.index(MARKS[k], at)
        cuts += [at, at + len(MARKS[k])]
        at = cuts[-1]
    for k, part in zip(order, whole.cut(cuts)[2::2]):
        parts[k] = part
    return parts[0] + parts[1] + parts[2]


def documents_of(column: pa.Array) -> Iterator[tuple[Pieces, memoryview]]:
    """Each text of an Arrow string column as one descriptor over the column's bytes."""
    raw, offsets = string_bytes(column)
    text = memoryview(raw).cast("B") if len(raw) else memoryview(b"")
    buffers = (memoryview(SENTINELS), text)
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        yield Pieces(buffers, [(1, a, b - a)]), text[a:b]


_DIGEST = ("doc_id long, n long, form string, prefix_chars long, middle_chars long, "
           "output_sha256 string, restored_sha256 string")


def _task(with_output: bool):
    schema = [f.strip().rsplit(" ", 1) for f in (_DIGEST + (", output string" if with_output else "")).split(",")]
    kinds = pa.schema([(name, pa.int64() if kind == "long" else pa.string()) for name, kind in schema])

    def run(batches):
        for batch in batches:
            rows = []
            for doc_id, (document, text) in zip(batch.column(0).to_pylist(), documents_of(batch.column(1))):
                n, body = code_points(text), bytes(text)
                form, a, b = plan(doc_id, n, any(m in body for m in MARKS.values()))
                out = arrange(document, form, byte_offsets(text, [a, b]) if form != "plain" else [])
                told = out.tobytes()
                plain = form == "plain"
                row = (doc_id, n, form, None if plain else a, None if plain else b - a,
                       out.sha256(), restore(told, form).sha256())
                rows.append(row + (told.decode("utf-8", "replace"),) if with_output else row)
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows) if rows else [[]] * len(kinds), kinds)],
                                  schema=kinds)
    return run


def fill_in_middle(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", with_output: bool = True) -> DataFrame:
    """One row per document: n, form, prefix_chars, middle_chars (null if plain), the digests of the
    output and of the text restored from it, and ``output`` itself unless turned off."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    return map_arrow(rows, _task(with_output), _DIGEST + (", output string" if with_output else ""))


def fim_digest(docs: DataFrame) -> DataFrame:
    return fill_in_middle(docs, with_output=False)
