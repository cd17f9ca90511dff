"""Fill-in-middle transformation over piece tables (operator 12).

Method. A document is a list of descriptors (buffer, start, length) over two
immutable buffers, the bytes of its batch of texts and the bytes of the
sentinels. Cutting splits descriptors, an arrangement permutes them and puts
sentinel descriptors between them, and nothing copies text before a document is
rendered. Restoring reads a rendered document as one descriptor again, splits it
at its sentinels, and applies the inverse permutation. Digests stream over the
descriptors.

A unit is a word with the white space before it; white space at the end of a
text is a unit of its own. The cuts, whether a document is transformed and how
come from the SHA-256 of the seed and the document's id, so they don't depend
on partitions, on other rows or on the run.

Scale. One pass over the texts, no shuffle, no state between rows. A task holds
a slice of about 4 MB of texts, or one longer text, and its rendering.

Results in odd cases. Null text: as the empty text, which stays plain with no
unit. A text that contains a sentinel stays plain. White space alone: one unit.
A null id is drawn as the empty id. Repeated rows give equal results; an empty
table gives none. Extra columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from orderlens.llm import textbatch as tb

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: The sentinel buffer and where each sentinel lies in it.
SENTINELS = (PREFIX + SUFFIX + MIDDLE).encode()
_AT = {PREFIX: (0, 3), SUFFIX: (3, 3), MIDDLE: (6, 3)}
#: For each form the pieces in their order, each led by its sentinel. Pieces are numbered as in the text: prefix, middle, suffix.
FORMS = {"psm": ((PREFIX, 0), (SUFFIX, 2), (MIDDLE, 1)), "spm": ((SUFFIX, 2), (PREFIX, 0), (MIDDLE, 1))}
TEXT, SENTINEL = 0, 1


@dataclass(frozen=True)
class Rule:
    """Which documents are transformed, and how: percent of all, percent of those suffix first."""

    seed: int = 42
    rate: int = 50
    suffix_first: int = 80

    def draw(self, doc_id, n: int) -> tuple[int, int, str]:
        """(units of the prefix, units up to the middle's end, form) of a document of ``n`` units."""
        digest = sha256(f"{self.seed}:{'' if doc_id is None else doc_id}".encode()).digest()
        one, two, three, four = (int.from_bytes(digest[i : i + 4], "big") for i in (0, 4, 8, 12))
        a, b = sorted((one % (n + 1), two % (n + 1)))
        form = "plain" if three % 100 >= self.rate else "spm" if four % 100 < self.suffix_first else "psm"
        return a, b, form


@dataclass(frozen=True)
class Pieces:
    """A document as descriptors (buffer, start, length) over immutable buffers."""

    buffers: tuple[memoryview, memoryview]
    table: tuple[tuple[int, int, int], ...]

    def split(self, *at: int) -> tuple[Pieces, ...]:
        """The document cut at ascending byte places of it: one document more than places."""
        out: list[list[tuple[int, int, int]]] = [[]]
        place, rest = 0, list(at)
        for buffer, start, length in self.table:
            while rest and rest[0] <= place + length:
                head = rest.pop(0) - place
                out[-1].append((buffer, start, head))
                out.append([])
                start, length, place = start + head, length - head, place + head
            out[-1].append((buffer, start, length))
            place += length
        return tuple(Pieces(self.buffers, tuple(d for d in t if d[2])) for t in out)

    def __add__(self, other: Pieces) -> Pieces:
        return Pieces(self.buffers, self.table + other.table)

    def views(self) -> Iterator[memoryview]:
        for buffer, start, length in self.table:
            yield self.buffers[buffer][start : start + length]

    def render(self) -> bytes:
        return b"".join(self.views())

    def sha256(self) -> str:
        digest = sha256()
        for view in self.views():
            digest.update(view)
        return digest.hexdigest()


def arrange(pieces: tuple[Pieces, ...], form: str) -> Pieces:
    """Prefix, middle and suffix in the order of ``form``, each led by its sentinel."""
    buffers, table = pieces[0].buffers, ()
    for sentinel, k in FORMS[form]:
        table += ((SENTINEL, *_AT[sentinel]), *pieces[k].table)
    return Pieces(buffers, table)


def restore(output: bytes | memoryview, form: str) -> Pieces:
    """The text of a rendered document: cut at its sentinels, the pieces put back in their places."""
    output = bytes(output)
    whole = Pieces((memoryview(output), memoryview(SENTINELS)), ((TEXT, 0, len(output)),))
    if form == "plain":
        return whole
    cuts, at = [], 0
    for sentinel, _ in FORMS[form]:
        at = output.index(sentinel.encode(), at)
        cuts += [at, at + len(sentinel)]
        at += len(sentinel)
    parts = whole.split(*cuts)[2::2]  # what follows each sentinel
    back = {k: part for (_, k), part in zip(FORMS[form], parts, strict=True)}
    return back[0] + back[1] + back[2]


def _code_points(raw: np.ndarray) -> int:
    return len(raw) - int(np.count_nonzero((raw & 0xC0) == 0x80))


def transformed(ids: list, column: pa.Array, rule: Rule) -> Iterator[tuple[int, str, int | None, int | None, Pieces]]:
    """(units, form, code points of the prefix, of the middle, output) of each text of a column."""
    data, offsets = tb.utf8(column)
    _, ends, words = tb.spans(data, offsets)
    first = np.cumsum(words) - words
    filled = pc.fill_null(column, "")
    marked = pc.or_(pc.or_(pc.match_substring(filled, PREFIX), pc.match_substring(filled, SUFFIX)), pc.match_substring(filled, MIDDLE)).to_pylist()
    buffers = (memoryview(np.ascontiguousarray(data)), memoryview(SENTINELS))
    for i, doc_id in enumerate(ids):
        lo, hi, k, at = int(offsets[i]), int(offsets[i + 1]), int(words[i]), int(first[i])
        text_end = int(ends[at + k - 1]) if k else lo
        n = k + (text_end < hi)
        a, b, form = rule.draw(doc_id, n)
        whole = Pieces(buffers, ((TEXT, lo, hi - lo),))
        if lo == hi or marked[i] or form == "plain":
            yield n, "plain", None, None, whole
            continue
        cut = [lo if u == 0 else hi if u > k else int(ends[at + u - 1]) for u in (a, b)]
        prefix, middle = _code_points(data[lo : cut[0]]), _code_points(data[cut[0] : cut[1]])
        yield n, form, prefix, middle, arrange(whole.split(cut[0] - lo, cut[1] - lo), form)


def transform(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rule: Rule = Rule(), texts: bool = True) -> DataFrame:
    """(id_col, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256) of every row, with ``texts`` also output.

    The restored text is rebuilt from the rendered output and the form alone.
    """
    names = {"n": LongType(), "form": StringType(), "prefix_chars": LongType(), "middle_chars": LongType()}
    names |= {"output_sha256": StringType(), "restored_sha256": StringType()} | ({"output": StringType()} if texts else {})
    schema = StructType([StructField(id_col, docs.schema[id_col].dataType), *[StructField(n, t) for n, t in names.items()]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tb.slices(batch, "_text"):
                columns: list[list] = [[] for _ in names]
                for n, form, prefix, middle, output in transformed(part.column(0).to_pylist(), part.column(1), rule):
                    rendered = output.render()
                    row = (n, form, prefix, middle, output.sha256(), restore(rendered, form).sha256())
                    for c, v in zip(columns, row + ((rendered.decode(),) if texts else ()), strict=True):
                        c.append(v)
                kinds = [pa.int64() if isinstance(t, LongType) else pa.string() for t in names.values()]
                yield pa.RecordBatch.from_arrays([part.column(0), *[pa.array(c, t) for c, t in zip(columns, kinds, strict=True)]], names=schema.names)

    return docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).mapInArrow(run, schema)


def restored(rows: DataFrame, output_col: str = "output", form_col: str = "form", name: str = "restored") -> DataFrame:
    """``rows`` with the text that the output and the form of each row stand for (null where either is null)."""

    @F.pandas_udf("string")
    def back(output, form):
        return output.combine(form, lambda o, f: None if o is None or f is None else restore(o.encode(), f).render().decode())

    return rows.withColumn(name, back(output_col, form_col))


def digests(docs: DataFrame) -> DataFrame:
    """What ``transform`` does to every document, as digests."""
    return transform(docs, texts=False)
