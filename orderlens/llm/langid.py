"""Language identification by compression (operator 2).

Method. Each language has a raw-content zstandard dictionary made of sampled
text of that language: pieces drawn by hash from all over the sampled texts, of
which a full dictionary holds some 500, from as many of up to 400 documents as
they hit. Texts are reduced to lower-case letters and single
blanks first, so that capitals, marks and digits say nothing, then cut into blocks and every block is compressed
with each dictionary; the language with the smallest total wins. The margin is
the relative gap to the runner-up; ``accepted`` is false where it is narrow.

Scale. The dictionaries are the only model: at most ``DICT_BYTES`` for each
learned language value, a bounded broadcast. Scoring is one pass over the texts
with no shuffle. A block bounds both memory and the influence of what a text
repeats of itself.

Results in odd cases. Null text or text without a letter: ``und``, score 0, not
accepted. No training rows: every text is ``und``. Ties go to the first
language in order. Rows with a null language never train. Extra columns are
ignored; an empty table gives an empty result; repeated rows repeat.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.llm.scratch import table
from orderlens.llm.split import held_out, sample_by_class

#: Bounds of the training sample: documents for each language, bytes of a piece of their lines, and bytes of a dictionary.
SAMPLE_DOCS = 400
PIECE = 256
DICT_BYTES = 1 << 17
BLOCK = 8192
LEVEL = 3
#: Relative gap below which a prediction is rejected.
NARROW = 0.005
#: A text that is this undecided is compressed again at a level with shorter matches.
FINE_LEVEL = 12

#: Unicode's letters; digits, fractions and circled numbers are none.
_LETTER = regex.compile(r"\p{L}")


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> dict[str, bytes]:
    """Raw dictionary content of each language, from the rows of ``docs`` with a language."""
    rows = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(id_col).alias("_id"), F.col(lang_col).alias("_lang"), F.col(text_col).alias("_text")
    )
    rows = sample_by_class(rows, "_id", "_lang", SAMPLE_DOCS)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                own = pieces(text.as_py().encode())
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(own), pa.string()), pa.array(own, pa.binary())], names=["_lang", "_piece"])

    drawn = rows.select("_lang", "_text").mapInArrow(cut, "_lang string, _piece binary").distinct()
    drawn = table(drawn.withColumn("_hash", F.pmod(F.xxhash64("_piece", F.lit("piece")), F.lit(1 << 30))), "pieces")
    # about two dictionaries a language reach the driver
    sizes = drawn.groupBy("_lang").agg(F.sum(F.octet_length("_piece")).alias("_bytes"))
    drawn = drawn.join(sizes, "_lang").where(F.col("_hash") / float(1 << 30) * F.col("_bytes") <= 2 * DICT_BYTES)
    out: dict[str, list[bytes]] = {}
    for r in sorted(drawn.select("_lang", "_hash", "_piece").collect(), key=lambda r: (r["_lang"], r["_hash"], bytes(r["_piece"]))):
        out.setdefault(r["_lang"], []).append(bytes(r["_piece"]))
    return {lang: b" ".join(parts)[:DICT_BYTES] for lang, parts in sorted(out.items())}


def pieces(text: bytes) -> list[bytes]:
    """The distinct lines of a text, reduced and cut; an empty piece where there is none."""
    lines = (letters(line).strip() for line in dict.fromkeys(text.split(b"\n")))
    return list(dict.fromkeys(line[k : k + PIECE] for line in lines for k in range(0, len(line), PIECE))) or [b""]


_FOLD = np.full(256, 32, np.uint8)
_FOLD[97:123] = _FOLD[65:91] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)


def letters(data: bytes) -> bytes:
    """UTF-8 with capitals (ASCII and Latin-1) lowered and every run of other ASCII made one blank."""
    raw = np.frombuffer(data, np.uint8)
    x = _FOLD[raw]
    if len(x) > 1:
        after = raw[:-1] == 0xC3
        x[1:][after & (raw[1:] >= 0x80) & (raw[1:] <= 0x9E) & (raw[1:] != 0x97)] += 32
        blank = x == 32
        x = x[np.concatenate([[True], ~(blank[1:] & blank[:-1])])]
    return x.tobytes()


class Classifier:
    def __init__(self, dictionaries: dict[str, bytes]):
        import zstandard as z

        def packers(level: int) -> list:
            out = []
            for raw in dictionaries.values():
                d = z.ZstdCompressionDict(raw, dict_type=z.DICT_TYPE_RAWCONTENT) if raw else None
                if d:
                    d.precompute_compress(level=level)
                out.append(z.ZstdCompressor(level=level, dict_data=d, write_checksum=False, write_content_size=False))
            return out

        self.langs = list(dictionaries)
        self.coarse, self.fine = packers(LEVEL), packers(FINE_LEVEL)

    def __call__(self, text: str | None) -> tuple[str, float]:
        """(language, relative margin to the next)."""
        if not text or not self.langs or not _LETTER.search(text):
            return "und", 0.0
        data = letters(text.encode())
        lang, margin = self._smallest(data, self.coarse)
        return (lang, margin) if margin >= 2 * NARROW else self._smallest(data, self.fine)

    def _smallest(self, data: bytes, packers: list) -> tuple[str, float]:
        sizes = [0] * len(self.langs)
        for at in range(0, len(data), BLOCK):
            block = data[at : at + BLOCK]
            for i, p in enumerate(packers):
                sizes[i] += len(p.compress(block))
        order = sorted(range(len(sizes)), key=lambda i: (sizes[i], i))
        if len(order) == 1:
            return self.langs[0], 1.0
        return self.langs[order[0]], (sizes[order[1]] - sizes[order[0]]) / sizes[order[1]]


def identifier(spark: SparkSession, dictionaries: dict[str, bytes], narrow: float = NARROW):
    """A function of a text column: a struct of its language, the margin (0 to 1), and whether that is accepted.

    Only the text goes through Python; the other columns of a row stay where they are.
    """
    shared = spark.sparkContext.broadcast(dictionaries)

    @F.arrow_udf("struct<lang string, margin double, accepted boolean>")
    def found(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        classify = Classifier(shared.value)
        for text in texts:
            pairs = [classify(t.as_py()) for t in text]
            columns = [pa.array([p[0] for p in pairs], pa.string()), pa.array([p[1] for p in pairs], pa.float64())]
            yes = pa.array([m >= narrow and g != "und" for g, m in pairs], pa.bool_())
            yield pa.StructArray.from_arrays([*columns, yes], names=["lang", "margin", "accepted"])

    return found


def identify(docs: DataFrame, dictionaries: dict[str, bytes], text_col: str = "text", narrow: float = NARROW) -> DataFrame:
    """``docs`` with lang_pred, margin (double, 0 to 1) and accepted added; columns of these names are replaced."""
    out = docs.withColumn("lang_pred", identifier(docs.sparkSession, dictionaries, narrow)(F.col(text_col)))
    return out.withColumn("margin", F.col("lang_pred.margin")).withColumn("accepted", F.col("lang_pred.accepted")).withColumn("lang_pred", F.col("lang_pred.lang"))


def predict(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, accepted): learnt from the rows not held out, applied to all."""
    rest = docs.select("doc_id", "text", "lang").where(~held_out("doc_id", 5, 0))
    out = identify(docs.select("doc_id", "text"), learn(rest))
    # a margin of a third or more is certain; the score is the margin on that scale
    return out.select(
        "doc_id", held_out("doc_id", 5, 0).alias("held_out"), "lang_pred", F.least(F.col("margin") * 3, F.lit(1.0)).alias("score"), "accepted"
    )


def keep_identified(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose language is clear."""
    rest = docs.select("doc_id", "text", "lang").where(~held_out("doc_id", 5, 0))
    return docs.where(identifier(docs.sparkSession, learn(rest))(F.col("text"))["accepted"])
