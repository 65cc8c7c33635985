"""SentencePiece encoding and decoding, giant texts by a max-plus scan.

For a BPE model the encoding of a text is the one segmentation into pieces in
which every two neighbouring pieces, joined, would again be encoded as those
two.  So segmentations are paths through a lattice of pieces whose edges have
weight 0 (the pair is stable) or minus infinity, and the encoding is the path
of weight 0: a max-plus problem, which can be cut anywhere.

A text of two or more chunks is cut at fixed places.  Each chunk (with as much
context on both sides as the longest piece) yields a transfer matrix from the
states at its left edge to those at its right edge; a state is the piece that
covers the last character before the edge.  Matrices combine associatively: a
balanced tree multiplies them up and hands the best states back down.  Then
every chunk, knowing its two states, is encoded on its own.  No text passes
through one task as a whole, but for the row that the result itself is.

Within a chunk the lattice is only walked near the edges: where no piece of
the vocabulary holds the two characters side by side, no path crosses, and the
chunk's matrix is the product of the two ends'.

Decoding joins the pieces again.  It returns the text, except that U+2581,
which the model uses for spaces, comes back as a space.

Defined results: a null or empty text has no tokens and decodes to the empty
text; repeated rows each get a row; null ids stay null; an empty table gives no
rows; extra columns are ignored.
"""

from __future__ import annotations

import heapq
import os
from collections.abc import Iterator

import numpy as np
import pandas as pd
import sentencepiece
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm.base import pick, register, stored, table

#: The vocabulary file; read once on the driver, its bytes go to the tasks.
MODEL_PATH = os.environ.get("SENTENCEPIECE_MODEL", "/opt/tokenizers/piece_bpe_32k.model")
#: Characters of a chunk; texts of two chunks or more are cut.
CHUNK = 8192
SPACE = "▁"
NEVER = float("-inf")
START = 0
Matrix = dict[int, dict[int, float]]


def load_model(path: str = MODEL_PATH) -> bytes:
    with open(path, "rb") as f:
        return f.read()


class Pieces:
    """The vocabulary, its library coder, and the lattice of a BPE model."""

    def __init__(self, model: bytes):
        self.coder = sentencepiece.SentencePieceProcessor(model_proto=model)
        c = self.coder
        special = lambda i: c.is_byte(i) or c.is_control(i) or c.is_unknown(i)
        self.ids = {c.id_to_piece(i): i for i in range(c.vocab_size()) if not special(i)}
        self.byte_ids = {b: c.piece_to_id(f"<0x{b:02X}>") for b in range(256)}
        self.scores = {p: c.get_score(i) for p, i in self.ids.items()}
        self.inside = {pair for p in self.ids for pair in zip(p, p[1:])}
        self.longest = max(map(len, self.ids))
        self.pairs: dict[tuple[str, str], bool] = {}
        if c.encode(" a  b") != self.encode(SPACE * 2 + "a" + SPACE * 2 + "b"):
            raise ValueError("only models with an identity normalizer and a space prefix can be cut into chunks")

    def merge(self, text: str) -> list[str]:
        """BPE of a piece of prepared text: best-scored, then leftmost, neighbours first."""
        parts: list[str | None] = list(text)
        nxt, prv = list(range(1, len(parts) + 1)), list(range(-1, len(parts) - 1))
        heap: list[tuple[float, int, int, str]] = []

        def offer(i: int) -> None:
            j = nxt[i]
            if j < len(parts):
                joined = parts[i] + parts[j]
                if joined in self.scores:
                    heapq.heappush(heap, (-self.scores[joined], i, j, joined))

        for i in range(len(parts) - 1):
            offer(i)
        while heap:
            _, i, j, joined = heapq.heappop(heap)
            if parts[i] is None or j >= len(parts) or parts[j] is None or nxt[i] != j or parts[i] + parts[j] != joined:
                continue
            parts[i], parts[j] = joined, None
            nxt[i] = nxt[j]
            if nxt[i] < len(parts):
                prv[nxt[i]] = i
            offer(i)
            if prv[i] >= 0:
                offer(prv[i])
        return [p for p in parts if p is not None]

    def stable(self, a: str, b: str) -> bool:
        """Whether the two pieces, joined, are encoded as themselves (the edge's weight is 0)."""
        if (a[-1], b[0]) not in self.inside:
            return True
        got = self.pairs.get((a, b))
        if got is None:
            if len(self.pairs) > 100_000:
                self.pairs.clear()
            got = self.pairs[(a, b)] = self.merge(a + b) == [a, b]
        return got

    def is_piece(self, p: str) -> bool:
        return len(p) == 1 or p in self.ids

    def encode(self, text: str) -> list[int]:
        """The ids of prepared text (spaces are U+2581), which may begin inside a word."""
        if text.startswith(SPACE):
            return self.coder.encode(text[1:])
        at = next((i for i in range(1, len(text)) if text[i] == SPACE and (text[i - 1], SPACE) not in self.inside), len(text))
        out: list[int] = []
        for p in self.merge(text[:at]):
            out += [self.ids[p]] if p in self.ids else [self.byte_ids[b] for b in p.encode("utf-8", "replace")]
        return out + (self.coder.encode(text[at + 1:]) if at < len(text) else [])

    def cut_after(self, text: str, at: int, end: int) -> int | None:
        """The first place in (at, end] that no piece can cross."""
        return next((i for i in range(at + 1, min(end, len(text) - 1) + 1) if (text[i - 1], text[i]) not in self.inside), None)

    def cut_before(self, text: str, at: int, begin: int) -> int | None:
        return next((i for i in range(min(at, len(text) - 1), begin, -1) if (text[i - 1], text[i]) not in self.inside), None)

    def edge_states(self, text: str, at: int) -> dict[int, tuple[int, int]]:
        """State -> (start, end) of the pieces that cover the character before ``at``."""
        n = self.longest
        return {_state(at - a, e - at): (a, e) for a in range(max(0, at - n), at)
                for e in range(at, min(len(text), a + n) + 1) if self.is_piece(text[a:e])}

    def walk(self, text: str, heads: dict[tuple[int, int], dict[int, float]], stop: int) -> dict[tuple[int, int], dict[int, float]]:
        """Max-plus forward pass from the pieces in ``heads`` (with their weight
        from each entry) to all pieces that start before ``stop`` and end at or after it."""
        ends: dict[int, dict[tuple[int, int], dict[int, float]]] = {}
        for node, w in heads.items():
            ends.setdefault(node[1], {})[node] = w
        out: dict[tuple[int, int], dict[int, float]] = {}
        at = min(ends, default=stop)
        while ends:
            for node, w in ends.pop(at, {}).items():
                if at >= stop:
                    if node[0] < stop:
                        _take(out.setdefault(node, {}), w)
                    continue
                before = text[node[0]:node[1]]
                for e in range(at + 1, min(len(text), at + self.longest) + 1):
                    piece = text[at:e]
                    if self.is_piece(piece) and (not before or self.stable(before, piece)):
                        _take(ends.setdefault(e, {}).setdefault((at, e), {}), w)
            at += 1
        return out

    def transfer(self, left: str, body: str, right: str, first: bool, last: bool) -> Matrix:
        """The chunk's matrix: entry state -> exit state -> weight."""
        text, p0, p1 = left + body + right, len(left), len(left) + len(body)
        entries = {START: (p0, p0)} if first else self.edge_states(text, p0)
        heads: dict[tuple[int, int], dict[int, float]] = {}
        for s, node in entries.items():
            heads.setdefault(node, {})[s] = 0.0
        reach = max((e for _, e in entries.values()), default=p0)
        begin = self.cut_after(text, reach, p1) if not first else p0
        end = self.cut_before(text, p1, begin) if begin is not None else None
        if begin is None or end is None:
            # no such place: the whole chunk is walked from every entry
            exits = self.walk(text, heads, p1)
            ways = {s: {n: w[s] for n, w in exits.items() if s in w} for s in entries}
        else:
            entered: dict[int, float] = {START: 0.0}
            if not first:
                entered = {}
                for node, w in self.walk(text, heads, begin).items():
                    if node[1] == begin:
                        _take(entered, w)
            tail = self.walk(text, {(end, end): {START: 0.0}}, p1)
            if end == p1:       # the edge itself is such a place: any piece that ends there
                tail = {(a, e): {START: 0.0} for a, e in self.edge_states(text, p1).values() if e == p1}
            ways = {s: {n: w + t[START] for n, t in tail.items()} for s, w in entered.items()}
        return {s: {_state(p1 - a, e - p1): w for (a, e), w in to.items() if e == p1 or not last} for s, to in ways.items()}


def _state(back: int, ahead: int) -> int:
    return back * 4096 + ahead


def _take(into: dict[int, float], other: dict[int, float]) -> None:
    for k, w in other.items():
        if w > into.get(k, NEVER):
            into[k] = w


def combine(a: Matrix, b: Matrix) -> Matrix:
    """The max-plus product."""
    out: Matrix = {}
    for i, row in a.items():
        to: dict[int, float] = {}
        for k, w in row.items():
            _take(to, {j: w + v for j, v in b.get(k, {}).items()})
        out[i] = to
    return out


def best_states(matrices: list[Matrix]) -> list[tuple[int, int]]:
    """(entry, exit) state of every chunk on the best path: products up a
    balanced tree, choices down it."""
    def build(lo: int, hi: int):
        if hi - lo == 1:
            return matrices[lo], None, None
        mid = (lo + hi) // 2
        a, b = build(lo, mid), build(mid, hi)
        return combine(a[0], b[0]), a, b

    def choose(node, i: int, j: int, out: list[tuple[int, int]]) -> None:
        _, a, b = node
        if a is None:
            out.append((i, j))
            return
        k = max((k for k in a[0][i] if j in b[0].get(k, {})), key=lambda k: a[0][i][k] + b[0][k][j])
        choose(a, i, k, out)
        choose(b, k, j, out)

    tree = build(0, len(matrices))
    ends = tree[0].get(START, {})
    if not ends:
        raise ValueError("no path through the text's lattice")
    out: list[tuple[int, int]] = []
    choose(tree, START, max(ends, key=lambda j: (ends[j], -j)), out)
    return out


def prepared(text: str) -> str:
    return SPACE + text.replace(" ", SPACE) if text else ""


def cut_text(text: str, size: int, context: int) -> list[tuple[int, str, str, str, bool]]:
    """(number, left context, body, right context, is last) of the prepared text's chunks."""
    s = prepared(text)
    n = max(1, len(s) // size)
    edges = [*range(0, n * size, size), len(s)]
    return [(k, s[max(0, edges[k] - context):edges[k]], s[edges[k]:edges[k + 1]],
             s[edges[k + 1]:edges[k + 1] + context], k == n - 1) for k in range(n)]


def encode_column(model: bytes, text: Column) -> Column:
    """struct(ids, round_trip) of texts that are encoded whole."""
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        coder = sentencepiece.SentencePieceProcessor(model_proto=model)
        for batch in batches:
            # one text's Python integers at a time; a batch is held as packed arrays
            ids, same = [], []
            for t in batch:
                got = coder.encode(t or "")
                same.append(coder.decode(got) == (t or "").replace(SPACE, " "))
                ids.append(np.array(got, dtype=np.int32))
            yield pd.DataFrame({"ids": ids, "round_trip": same})

    return F.pandas_udf(run, "ids array<int>, round_trip boolean")(text)


def decode_column(model: bytes, ids: Column) -> Column:
    """The text of an array of ids; null for null."""
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        coder = sentencepiece.SentencePieceProcessor(model_proto=model)
        for batch in batches:
            yield pd.Series([None if x is None else coder.decode([int(i) for i in x]) for x in batch], dtype=object)

    return F.pandas_udf(run, "string")(ids)


def encode_giants(giants: DataFrame, model: bytes, size: int = CHUNK) -> DataFrame:
    """doc_id, n_chars, ids, round_trip of texts of two chunks or more."""
    longest = Pieces(model).longest
    if size < 2 * longest:
        raise ValueError(f"chunks of {size} characters are shorter than two pieces of {longest}")

    def cut(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([[{"k": k, "left": a, "body": b, "right": c, "last": z} for k, a, b, c, z in cut_text(t, size, longest)]
                             for t in batch])

    chunk = "struct<k:int,left:string,body:string,right:string,last:boolean>"
    rows = giants.withColumn("row", F.monotonically_increasing_id())
    chunks = rows.select("row", "doc_id", "n_chars", F.explode(F.pandas_udf(cut, f"array<{chunk}>")("text")).alias("c"))
    # chunks of one text go to different tasks; the table pins the row numbers
    chunks = stored(chunks.select("row", "doc_id", "n_chars", "c.*").repartition("row", "k"), "pieces-chunks")

    def transfers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pieces = Pieces(model)
        for b in batches:
            found = [pieces.transfer(*x) for x in zip(b["left"], b["body"], b["right"], b["k"] == 0, b["last"])]
            flat = [[{"i": i, "j": j, "w": w} for i, to in m.items() for j, w in to.items()] for m in found]
            yield pd.DataFrame({"row": b["row"], "k": b["k"], "m": flat})

    matrices = chunks.select("row", "k", "left", "body", "right", "last").mapInPandas(
        transfers, "row long, k int, m array<struct<i:int,j:int,w:double>>")

    def resolve(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("k")
        tables: list[Matrix] = []
        for entries in group["m"]:
            m: Matrix = {}
            for e in entries:
                m.setdefault(e["i"], {})[e["j"]] = e["w"]
            tables.append(m)
        states = best_states(tables)
        return pd.DataFrame({"row": group["row"].to_numpy(), "k": group["k"].to_numpy(),
                             "entry": [i % 4096 for i, _ in states], "exit": [j % 4096 for _, j in states]})

    states = matrices.groupBy("row").applyInPandas(resolve, "row long, k int, entry int, exit int")
    spans = chunks.join(states, ["row", "k"])

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pieces = Pieces(model)
        for b in batches:
            ids, back = [], []
            for body, right, begin, end in zip(b["body"], b["right"], b["entry"], b["exit"]):
                part = body[begin:] + right[:end] if begin <= len(body) else ""
                got = pieces.encode(part) if part else []
                ids.append(np.array(got, dtype=np.int32))
                back.append(_spell(pieces, got) == part)
            yield pd.DataFrame({"row": b["row"], "k": b["k"], "doc_id": b["doc_id"], "n_chars": b["n_chars"],
                                "ids": ids, "ok": back})

    done = spans.select("row", "k", "doc_id", "n_chars", "body", "right", "entry", "exit").mapInPandas(
        encode, "row long, k int, doc_id long, n_chars long, ids array<int>, ok boolean")
    return (done.groupBy("row").agg(F.first("doc_id").alias("doc_id"), F.first("n_chars").alias("n_chars"),
                                    F.sort_array(F.collect_list(F.struct("k", "ids"))).alias("parts"),
                                    F.bool_and("ok").alias("round_trip"))
            .select("doc_id", "n_chars", F.flatten(F.transform("parts", lambda p: p["ids"])).alias("ids"), "round_trip"))


def _spell(pieces: Pieces, ids: list[int]) -> str:
    """The prepared text that the ids stand for."""
    out, raw = [], bytearray()
    c = pieces.coder
    for i in ids:
        if c.is_byte(i):
            raw.append(int(c.id_to_piece(i)[3:5], 16))
            continue
        if raw:
            out.append(raw.decode("utf-8", "replace"))
            raw.clear()
        out.append(c.id_to_piece(i))
    return "".join(out) + raw.decode("utf-8", "replace")


def encode_documents(docs: DataFrame, model: bytes, size: int = CHUNK, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """doc_id, n_chars, n_tokens, token_ids, round_trip (decoding gives the text back) of every row."""
    src = pick(docs, doc_id=id_col, text=text_col).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    src = src.withColumn("n_chars", F.length("text").cast("long"))
    # the prepared text has one more character, its space prefix
    whole = src.where(F.col("n_chars") + 1 < 2 * size).withColumn("e", encode_column(model, F.col("text"))).select(
        "doc_id", "n_chars", F.col("e.ids").alias("ids"), F.col("e.round_trip").alias("round_trip"))
    giants = encode_giants(src.where(F.col("n_chars") + 1 >= 2 * size), model, size)
    return whole.unionByName(giants).select("doc_id", "n_chars", F.size("ids").cast("long").alias("n_tokens"),
                                            F.col("ids").alias("token_ids"), "round_trip")


@register("op1_sentencepiece")
def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(table(spark, sf_dir, "documents"), load_model())
