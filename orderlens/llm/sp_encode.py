"""SentencePiece encoding and decoding by a max-plus scan (operator 10).

Method. A text is normalised as the model says (a blank in front, blanks as
U+2581) and cut into the pieces of the model's vocabulary so that the sum of
their scores is the largest (characters outside the vocabulary become their
byte pieces). A text longer than a chunk is cut at fixed places into chunks.
The state at a cut is how many characters of a piece lie before it; a chunk's
transfer matrix holds the best score from each state at its left cut to each
state at its right cut. The matrices are made in parallel and combined
associatively: blocks of ``SCAN`` neighbours are multiplied (max-plus) in parallel,
their products again, until a document has one block left. Its best states are
then passed down: the states at the ends of a block give those at the cuts inside
it, level by level, and each chunk is traced back by itself from its two states.
No piece goes on from another character to a blank, so a run of blanks with the
characters after it is cut by itself, once, and remembered.

The scores are a unigram model's own. A model of merges (the given one) has only
the ranks of its merges for scores, whose sums mean nothing; its pieces are given
the log-probabilities of a Zipf law over the ranks. The best sum is then not
always the cut that replaying the merges gives; both decode to the same text.

Scale. A document within one chunk is encoded where it is read. Longer ones
become rows of chunks, dealt over the tasks; only a matrix of some hundred
numbers a chunk travels, and no task holds more than SCAN of them of a document.
The model's file is read by every task from its path; the vocabulary is a fixed
size.

Results in odd cases. Null or empty text: no ids, decoded to the empty text.
Ties prefer the longer last piece. Repeated rows repeat, null ids are kept; extra
columns are ignored; an empty table gives an empty result. A byte run that is
not UTF-8 can't arise from encoding; decoding replaces it.
"""

from __future__ import annotations

import functools
import itertools
import math
import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, LongType, StringType, StructField, StructType

from orderlens.llm.scratch import table

MODEL = "piece_bpe_32k.model"
#: Characters of a chunk; longer documents are encoded in parallel.
CHUNK = 1 << 16
#: Neighbouring matrices that are multiplied in one group.
SCAN = 64
BLANK = "▁"
_NONE = -np.inf
#: Scores below mark pieces without a rank of their own; units of a log-probability.
UNRANKED = -1e8
UNIT = 10_000
#: Words of a generation that a worker remembers; it holds two.
_REMEMBERED = 3 << 16


def model_path(name: str = MODEL) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


class Vocabulary:
    """Scores and ids by piece, with a memory of the cuts of words."""

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        self.pieces = [sp.id_to_piece(i) for i in range(n)]
        self.plain = [not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i)) for i in range(n)]
        scores = [sp.get_score(i) for i in range(n)]
        used = [s for s, k in zip(scores, self.plain, strict=True) if k and s > UNRANKED]
        self.merges = all(s <= 0 and s == int(s) for s in used)
        if self.merges:  # ranks of merges: read as a Zipf law of the pieces, in whole units so that sums are exact
            least, size = min(used), math.log(len(used))
            scores = [float(round(-UNIT * (math.log1p(-max(s, least)) + size))) for s in scores]
        self.score = {p: (scores[i], i) for i, p in enumerate(self.pieces) if self.plain[i]}
        self.byte = {int(p[3:5], 16): i for i, p in enumerate(self.pieces) if sp.is_byte(i)}
        self.byte_of = {i: b for b, i in self.byte.items()}
        self.unknown = sp.unk_id()
        self.longest = max(map(len, self.score))
        #: a character without a piece costs more than any cut that avoids it
        self.worst = 2 * min(s for s, _ in self.score.values()) - 1
        # pieces that hold a blank after another character would let a piece cross a word's start
        self.crossing = any(BLANK in p[1:] and p.strip(BLANK) for p in self.score)
        self.words: dict[str, tuple[float, tuple[int, ...]]] = {}
        self.older: dict[str, tuple[float, tuple[int, ...]]] = {}

    @functools.cached_property
    def trie(self) -> dict:
        """The pieces by character: character -> (score of the piece that ends here or None, longer pieces). Decoding needs none."""
        out: dict = {}
        for p, (w, _) in self.score.items():
            node = out
            for c in p[:-1]:
                node = node.setdefault(c, [None, {}])[1]
            node.setdefault(p[-1], [None, {}])[0] = w
        return out

    def ids_of(self, piece: str) -> tuple[int, ...]:
        got = self.score.get(piece)
        if got:
            return (got[1],)
        return tuple(self.byte[b] for b in piece.encode()) if self.byte else (self.unknown,)

    def forward(self, text: str, start) -> tuple[list[float], list[int]]:
        """Best score and length of the last piece at each place of ``text``; start[s]: score of a piece that covers its first s characters."""
        n, trie, worst = len(text), self.trie, self.worst
        best = [_NONE] * (n + 1)
        back = [0] * (n + 1)
        for s in range(min(len(start), n + 1)):
            best[s] = float(start[s])
        for i in range(n):
            b = best[i]
            if b == _NONE:
                continue
            first = trie.get(text[i])
            if first is None or first[0] is None:
                if b + worst > best[i + 1]:
                    best[i + 1], back[i + 1] = b + worst, 1
            node, j = trie, i
            while j < n:
                entry = node.get(text[j])
                if entry is None:
                    break
                j += 1
                w, node = entry
                # at a tie the longer last piece stays: it starts earlier and is met first
                if w is not None and b + w > best[j]:
                    best[j], back[j] = b + w, j - i
        return best, back

    @functools.cached_property
    def matcher(self) -> tuple:
        """An automaton that finds (characters, score, ids) of every piece in a text, and what makes it find every character.

        A character without a piece is one of the automaton with the score ``worst``; those in no
        piece at all are read as one stand-in, whose ids are looked up by the character itself.
        """
        out, known = ahocorasick.Automaton(), {c for p in self.score for c in p}
        for p, (w, i) in self.score.items():
            out.add_word(p, (len(p), w, (i,)))
        for c in known.difference(self.score):
            out.add_word(c, (1, self.worst, self.ids_of(c)))
        other = next(c for c in map(chr, range(0xE000, 0x110000)) if c not in known)
        out.add_word(other, (1, self.worst, None))
        out.make_automaton()
        rest = re.compile(f"[^{re.escape(''.join(sorted(known)))}]")
        return out.iter, frozenset(known).issuperset, functools.partial(rest.sub, other)

    def cut(self, text: str) -> tuple[float, tuple[int, ...]]:
        """(score, ids) of the best cut of a text of its own; ``forward`` from its start, with the pieces found by the automaton."""
        pieces, covers, covered = self.matcher
        at = len(text)
        best, last = [_NONE] * (at + 1), [None] * (at + 1)
        best[0] = 0.0
        # by end, the longest first: at a tie the longer last piece stays
        for end, piece in pieces(text if covers(text) else covered(text)):
            end += 1
            score = best[end - piece[0]] + piece[1]
            if score > best[end]:
                best[end], last[end] = score, piece
        found = []
        while at > 0:
            n, _, ids = last[at]
            at -= n
            found.append(self.ids_of(text[at]) if ids is None else ids)
        found.reverse()
        return best[-1], tuple(itertools.chain.from_iterable(found))

    def word(self, w: str) -> tuple[float, tuple[int, ...]]:
        got = self.words.get(w)
        if got is None:
            got = self.older.get(w) or self.cut(w)
            if len(self.words) >= _REMEMBERED:
                # what is met again moves on to the new generation, so frequent words stay
                self.older, self.words = self.words, {}
            self.words[w] = got
        return got

    def encode(self, text: str) -> tuple[float, list[int]]:
        """(score, ids) of normalised text, word by word."""
        if not text:
            return 0.0, []
        if self.crossing:
            score, ids = self.cut(text)
            return score, list(ids)
        score, ids, known, word = 0.0, [], self.words, self.word
        for w in words(text):
            got = known.get(w) or word(w)
            score += got[0]
            ids += got[1]
        return score, ids

    @functools.cached_property
    def spelt(self) -> tuple[np.ndarray, np.ndarray]:
        """(bytes of all pieces with blanks for U+2581, offsets); a control piece is empty."""
        raw = [
            bytes([self.byte_of[i]]) if i in self.byte_of else p.replace(BLANK, " ").encode() if self.plain[i] else b""
            for i, p in enumerate(self.pieces)
        ]
        return np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(r) for r in raw])])

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> list[str]:
        """The texts of lists of ids, without the blank in front."""
        data, at = self.spelt
        start, size = at[ids], at[ids + 1] - at[ids]
        ends = np.cumsum(size)
        total = int(ends[-1]) if len(ends) else 0
        out = data[np.arange(total) + np.repeat(start - (ends - size), size)].tobytes()
        ends = np.concatenate([[0], ends])[offsets]
        texts = [out[a:b].decode("utf-8", "replace") for a, b in zip(ends, ends[1:], strict=False)]
        return [t[1:] if t.startswith(" ") else t for t in texts]


#: A blank run with what follows it; no piece goes on from another character to a blank.
_WORD = re.compile(f"{BLANK}+[^{BLANK}]*|[^{BLANK}]+")
_START = re.compile(f"(?<=[^{BLANK}]){BLANK}")


def words(text: str) -> list[str]:
    """The parts of ``text`` that no piece crosses: blanks and the characters up to the next blank."""
    return _WORD.findall(text)


@functools.lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def normal(text: str) -> str:
    return BLANK + text.replace(" ", BLANK) if text else ""


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Max-plus product."""
    return (a[:, :, None] + b[None, :, :]).max(axis=1)


def transfer(v: Vocabulary, chunk: str, ahead: str) -> np.ndarray:
    """[states, states] best score over ``chunk`` from each left state to each right one.

    State s on the left: the first s characters belong to a piece that began
    before. State t on the right: the last piece covers t characters of
    ``ahead``, the text after the chunk; its whole score counts here.
    """
    states = v.longest
    out = np.full((states, states), _NONE)
    text, n = chunk + ahead[: states - 1], len(chunk)
    # places where only a piece's end can be: what lies between the outer two is the same for all states
    first = last = None
    if not v.crossing:
        for m in _START.finditer(chunk):
            first = m.start()
            break
        at = n
        while first is not None and last is None:  # the last start, looked for from the end
            at = max(0, at - 256)
            found = [m.start() for m in _START.finditer(chunk, at)]
            last = found[-1] if found else None
    middle = v.encode(chunk[first:last])[0] if first is not None else 0.0
    for s in range(min(states, n + 1)):
        start = np.full(states, _NONE)
        start[s] = 0.0
        if first is None:
            out[s] = _right(v, text, n, start)
            continue
        head = v.forward(chunk[:first], start)[0][first]
        if head != _NONE:
            out[s] = _right(v, text[last:], n - last, np.array([head + middle]))
    return out


def _right(v: Vocabulary, text: str, n: int, start: np.ndarray) -> np.ndarray:
    """Best score of a cut whose last piece is the first to reach n, by the characters it covers after n."""
    best, _ = v.forward(text[:n], start)
    out = np.full(v.longest, _NONE)
    out[0] = best[n]
    for i in range(max(0, n - v.longest + 1), n):
        if best[i] == _NONE:
            continue
        for t in range(1, min(v.longest - (n - i), len(text) - n) + 1):
            got = v.score.get(text[i : n + t])
            if got is not None:
                out[t] = max(out[t], best[i] + got[0])
    return out


def trace(v: Vocabulary, chunk: str, ahead: str, left: int, right: int) -> list[int]:
    """The ids of the pieces that begin in ``chunk``, given its states."""
    n = len(chunk)
    start = np.full(v.longest, _NONE)
    start[min(left, v.longest - 1)] = 0.0
    text = chunk + ahead[: v.longest - 1]
    best, back = v.forward(text[:n], start)
    ends, at = [], n
    if right:
        # the piece that crosses the right cut
        options = []
        for i in range(max(0, n - v.longest + 1), n):
            got = v.score.get(text[i : n + right])
            if got is not None and best[i] != _NONE and n + right - i <= v.longest:
                options.append((best[i] + got[0], -i))
        at = -max(options)[1]
        ends.append((at, n + right))
    while at > left:
        ends.append((at - back[at], at))
        at -= back[at]
    return [i for a, b in reversed(ends) for i in v.ids_of(text[a:b])]


def cut_states(matrices: list[np.ndarray], left: int = 0, right: int = 0) -> list[int]:
    """The best state at every cut between two given states at the ends, from products of the suffixes with a vector."""
    n, states = len(matrices), len(matrices[0])
    end = np.full(states, _NONE)
    end[right] = 0.0
    suffix = [end]
    for m in reversed(matrices):
        suffix.append((m + suffix[-1][None, :]).max(axis=1))
    out = [left]
    for k in range(1, n):
        # the states already chosen on the left hold: of equally good paths the same one is followed everywhere
        through = matrices[k - 1][out[-1]] + suffix[n - k]
        out.append(int(np.argmax(through)))
    return [*out, right]


def _scan(made: DataFrame, longest: int, block: int) -> DataFrame:
    """(_row, _k, _l, _r, _s) of every chunk: its best states and its score, from the matrices (_row, _k, _m)."""
    number = F.floor(F.col("_k") / block).cast("int").alias("_b")

    def matrices(part: pa.Table) -> list[np.ndarray]:
        return [np.frombuffer(x.as_py()).reshape(longest, longest) for x in part["_m"]]

    def multiply(part: pa.Table) -> pa.Table:
        part = part.sort_by("_k")
        whole = functools.reduce(product, matrices(part))
        return pa.table({"_row": part["_row"][:1], "_k": part["_b"][:1], "_m": pa.array([whole.tobytes()], pa.binary())})

    levels = [made]
    while not levels[-1].where(F.col("_k") >= block).isEmpty():
        up = levels[-1].select("_row", "_k", "_m", number).groupBy("_row", "_b").applyInArrow(multiply, "_row long, _k int, _m binary")
        levels.append(table(up, "matrices"))

    def inside(part: pa.Table) -> pa.Table:
        part = part.sort_by("_k")
        m = matrices(part)
        states = cut_states(m, part["_from"][0].as_py(), part["_to"][0].as_py())
        scores = [float(x[states[k], states[k + 1]]) for k, x in enumerate(m)]
        ends = [pa.array(x, pa.int32()) for x in (states[:-1], states[1:])]
        return pa.table({"_row": part["_row"], "_k": part["_k"], "_l": ends[0], "_r": ends[1], "_s": scores})

    names = "_row long, _k int, _l int, _r int, _s double"
    top = levels[-1].select("_row", "_k", "_m", F.lit(0).alias("_b"), F.lit(0).alias("_from"), F.lit(0).alias("_to"))
    states = table(top.groupBy("_row", "_b").applyInArrow(inside, names), "states")
    for lower in reversed(levels[:-1]):
        ends = states.select("_row", F.col("_k").alias("_b"), F.col("_l").alias("_from"), F.col("_r").alias("_to"))
        down = lower.select("_row", "_k", "_m", number).join(ends, ["_row", "_b"]).select("_row", "_k", "_m", "_b", "_from", "_to")
        states = table(down.groupBy("_row", "_b").applyInArrow(inside, names), "states")
    return states


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, chunk: int = CHUNK, block: int = SCAN) -> DataFrame:
    """(id_col, ids, score) of every row of ``docs``."""
    path = path or model_path()
    kind = docs.schema[id_col].dataType
    rows = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    schema = StructType([StructField("_id", kind), StructField("ids", ArrayType(IntegerType())), StructField("score", DoubleType())])

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                got = [v.encode(normal(t.as_py())) for t in part.column(1)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), _lists([g[1] for g in got]), pa.array([g[0] for g in got], pa.float64())], names=schema.names
                )
            # workers live on after a task: what a batch needed goes back to the system
            pa.default_memory_pool().release_unused()

    short = rows.where(F.length("_text") < chunk).mapInArrow(whole, schema)
    return short.unionByName(_long(rows.where(F.length("_text") >= chunk), path, chunk, block, schema)).withColumnRenamed("_id", id_col)


def _lists(lists: list[list[int]]) -> pa.Array:
    offsets = np.zeros(len(lists) + 1, np.int32)
    np.cumsum([len(x) for x in lists], out=offsets[1:])
    flat = np.fromiter(itertools.chain.from_iterable(lists), np.int32, int(offsets[-1]))
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))


def _long(rows: DataFrame, path: str, chunk: int, block: int, schema: StructType) -> DataFrame:
    """Documents of several chunks: matrices, their scan by document, and a trace of each chunk."""
    longest = vocabulary(path).longest
    # a row's number tells repeated ids apart
    chunks = rows.withColumn("_row", F.monotonically_increasing_id()).withColumn("_norm", F.concat(F.lit(BLANK), F.replace("_text", F.lit(" "), F.lit(BLANK))))
    count = F.ceil(F.length("_norm") / chunk).cast("int")
    chunks = chunks.select("_row", "_id", "_norm", F.explode(F.sequence(F.lit(0), count - 1)).alias("_k"))
    chunks = chunks.select(
        "_row", "_id", "_k", F.substring("_norm", F.col("_k") * chunk + 1, F.lit(chunk)).alias("_chunk"),
        F.substring("_norm", (F.col("_k") + 1) * chunk + 1, F.lit(longest)).alias("_ahead"),
    )
    # written once: the numbers of the rows must not be drawn again; then dealt evenly
    chunks = table(chunks.repartition(F.xxhash64("_row", "_k")), "chunks")

    def matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(path)
        for batch in batches:
            got = [transfer(v, c.as_py(), a.as_py()).tobytes() for c, a in zip(batch.column(2), batch.column(3), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(got, pa.binary())], names=["_row", "_k", "_m"])

    made = table(chunks.select("_row", "_k", "_chunk", "_ahead").mapInArrow(matrices, "_row long, _k int, _m binary"), "matrices")

    states = _scan(made, longest, block)

    def back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(path)
        for batch in batches:
            c = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
            got = [trace(v, *[c[n][i].as_py() for n in ("_chunk", "_ahead", "_l", "_r")]) for i in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays([c["_row"], c["_id"], c["_k"], c["_s"], _lists(got)], names=["_row", "_id", "_k", "_s", "_ids"])

    kind = schema["_id"].dataType.simpleString()
    traced = chunks.join(states, ["_row", "_k"]).select("_row", "_id", "_k", "_chunk", "_ahead", "_l", "_r", "_s")
    traced = traced.mapInArrow(back, f"_row long, _id {kind}, _k int, _s double, _ids array<int>")
    whole = traced.groupBy("_row").agg(F.first("_id").alias("_id"), F.array_sort(F.collect_list(F.struct("_k", "_ids", "_s"))).alias("_parts"))
    return whole.select(
        "_id",
        F.flatten(F.transform("_parts", lambda p: p["_ids"])).alias("ids"),
        F.aggregate("_parts", F.lit(0.0), lambda a, p: a + p["_s"]).alias("score"),
    )


def decode(encoded: DataFrame, path: str | None = None, ids_col: str = "ids", out: str = "decoded") -> DataFrame:
    """``encoded`` with the text of its ids."""
    path = path or model_path()
    schema = StructType([*encoded.schema.fields, StructField(out, StringType())])
    at = encoded.columns.index(ids_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(path)
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                part = batch.slice(k, 256)
                lists = part.column(at).fill_null([])
                ids, counts = lists.flatten().to_numpy(zero_copy_only=False), pc.list_value_length(lists).to_numpy()
                texts = v.decode(ids.astype(np.int64), np.concatenate([[0], np.cumsum(counts)]))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], names=schema.names)
            pa.default_memory_pool().release_unused()

    return encoded.mapInArrow(run, schema)


def encoded_documents(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, n_tokens, score, ids, decoded_sha256, decoded_chars): the ids of every document and the digest of what they decode to."""
    d = decode(encode(docs, path=path), path)
    return d.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        "score",
        "ids",
        F.sha2("decoded", 256).alias("decoded_sha256"),
        F.length("decoded").cast("long").alias("decoded_chars"),
    )
