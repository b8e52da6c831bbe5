"""Tokens of two tokenizers over the same bytes: overlaps, groups, and how often ids meet in the corpus.

Both token sequences of a text are two sorted lists of ends. A merge path goes through them with a step for each
end. Diagonals ``PIECE`` steps apart are searched for where the path crosses them, which cuts the merge into pieces
of equal work that need nothing of one another but the token that spans the cut. A piece emits
an overlap for each stretch between two neighbouring ends, and its groups, which end where tokens of both kinds do.
Pieces of long texts are dealt out to the tasks; what a piece has before its first and after its last
common end is stitched to its neighbours.

Overlaps are added up over the corpus by pair of ids. Their counts go back to the texts: those of the most common
pairs by broadcast, ``BROADCAST_ROWS`` at most; what others hold is below a share of 1 / ``BROADCAST_ROWS`` each and is
shuffled.

Texts that are null, empty or not given back by both tokenizers byte by byte have no tokens and count as zeros.
Repeated texts count as often as they occur; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import asdict, dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.llm.tables import BROADCAST_ROWS, extended, written
from eventloom.llm.words import text_column

# Steps of the merge path in a piece.
PIECE = 16_384
# Texts with a longer run without white space go to the tokenizer that is linear in it.
LONG_RUN = 2_000
# An overlap's pair of ids is one number: the first id times this, plus the second.
PAIR = 1 << 31


@dataclass(frozen=True)
class Vocabulary:
    """Paths of a byte-level model of ``tokenizers`` (A), of the same vocabulary as ranks (may be None),
    and of a ``sentencepiece`` model (B)."""

    model_a: str
    ranks_a: str | None
    model_b: str


def _byte_of_char() -> dict[str, int]:
    """Byte-level models write a byte as the character of its number if that is visible, the others as the characters from 256 on."""
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in visible]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}


@cache
def _tokenizers(vocabulary: Vocabulary):
    """(encode A, encode B, tokens of A, of B, names of both)."""
    import sentencepiece
    from tokenizers import Tokenizer

    exact = Tokenizer.from_file(vocabulary.model_a)
    exact.encode_special_tokens = True
    table = _byte_of_char()

    def piece_a(piece: str) -> bytes:
        try:
            return bytes(table[c] for c in piece)
        except KeyError:
            return piece.encode()

    bytes_a = [piece_a(exact.id_to_token(i) or "") for i in range(exact.get_vocab_size())]
    fast = None
    if vocabulary.ranks_a is not None:
        import base64

        import tiktoken

        with open(vocabulary.ranks_a, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        # Byte-level pre-tokenization of the model file, as a pattern.
        pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
        fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def encode_a(text: str) -> np.ndarray:
        if fast is None or (len(text) > LONG_RUN and max(map(len, text.split()), default=len(text)) > LONG_RUN):
            return np.array(exact.encode(text, add_special_tokens=False).ids, np.int64)
        return fast.encode_to_numpy(text, disallowed_special=()).astype(np.int64)

    model = sentencepiece.SentencePieceProcessor(model_file=vocabulary.model_b)

    def encode_b(text: str) -> np.ndarray:
        return np.array(model.encode(text, num_threads=1), np.int64)

    def piece_b(i: int) -> bytes:
        piece = model.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if model.is_byte(i) else piece.replace("▁", " ").encode()

    bytes_b = [piece_b(i) for i in range(model.get_piece_size())]
    return encode_a, encode_b, Tokens(bytes_a), Tokens(bytes_b), Names(len(bytes_a), len(bytes_b))


class Tokens:
    """The bytes of the tokens of a vocabulary, by id."""

    def __init__(self, tokens: list[bytes]):
        self.widths = np.fromiter(map(len, tokens), np.int64)
        self.data = np.frombuffer(b"".join(tokens), np.uint8)
        self.starts = np.cumsum(self.widths) - self.widths

    def ends(self, ids: np.ndarray, start: int = 0) -> np.ndarray:
        return np.cumsum(self.widths[ids]) + start

    def give(self, ids: np.ndarray, wanted: np.ndarray) -> bool:
        """Whether the tokens one after the other are these bytes."""
        widths = self.widths[ids]
        if widths.sum() != len(wanted):
            return False
        places = np.repeat(self.starts[ids] - (np.cumsum(widths) - widths), widths) + np.arange(len(wanted))
        return bool((self.data[places] == wanted).all())


class Names:
    """Decimal ids with the mark that follows them, as fixed-width bytes: a's, a's last of a group, b's, b's last."""

    def __init__(self, size_a: int, size_b: int):
        marked = [f"{i}{mark}" for size, marks in ((size_a, ",|"), (size_b, ",;")) for mark in marks for i in range(size)]
        self.table = np.array(marked, "S")
        self.at = {"a": 0, "a|": size_a, "b": 2 * size_a, "b;": 2 * size_a + size_b}

    def _text(self, rows: np.ndarray) -> str:
        return self.table[rows].tobytes().replace(b"\0", b"")[:-1].decode()

    def listed(self, kind: str, ids: np.ndarray) -> str:
        return self._text(ids + self.at[kind])

    def groups(self, a: np.ndarray, b: np.ndarray, to_a: np.ndarray, to_b: np.ndarray) -> str:
        """All groups, which end after ``to_a`` and ``to_b`` ids: of each the ids of a, then those of b."""
        own_a, own_b = (np.repeat(np.arange(len(to)), np.diff(to, prepend=0)) for to in (to_a, to_b))
        rows = np.concatenate([a, b + self.at["b"]])
        rows[to_a - 1] += self.at["a|"]
        rows[len(a) + to_b - 1] += self.at["b;"] - self.at["b"]
        return self._text(rows[np.argsort(np.concatenate([own_a, own_b]), kind="stable")])


def encode_both(text: str, vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Ids of space + text by A and of text by B; both empty if one of them does not give the bytes back."""
    none = np.zeros(0, np.int64)
    if not text:
        return none, none
    encode_a, encode_b, tokens_a, tokens_b, _ = _tokenizers(vocabulary)
    wanted = np.frombuffer(b" " + text.encode(), np.uint8)
    b = encode_b(text)
    if not tokens_b.give(b, wanted):
        return none, none
    a = encode_a(" " + text)
    return (a, b) if tokens_a.give(a, wanted) else (none, none)


def crossing(a: np.ndarray, b: np.ndarray, diagonal: int) -> tuple[int, int]:
    """How many ends of ``a`` and of ``b`` are among the first ``diagonal`` of the merge, in which ``a`` goes first among equal ends."""
    low, high = max(0, diagonal - len(b)), min(diagonal, len(a))
    while low < high:
        middle = (low + high) // 2
        # The end at ``middle`` of a is among the first if it does not lie after the last one of b that would be.
        if a[middle] <= b[diagonal - middle - 1]:
            low = middle + 1
        else:
            high = middle
    return low, diagonal - low


def cut(a: np.ndarray, b: np.ndarray, piece: int) -> list[tuple[int, int, int, int]]:
    """(first of a, after the last of a, first of b, after the last of b) of the pieces of a merge of two lists of ends."""
    steps = len(a) + len(b)
    points = [crossing(a, b, d) for d in [*range(0, steps, piece), steps]]
    return [(i, i2, j, j2) for (i, j), (i2, j2) in zip(points, points[1:])]


@dataclass(frozen=True)
class Piece:
    """Part of a merge. ``a``, ``b``: ids from the first one that ends in it to the first one that ends after it, if any;
    ``ends_a``, ``ends_b``: their ends. ``own_a``, ``own_b``: how many end inside. ``begin``: the last end before it."""

    a: np.ndarray
    b: np.ndarray
    ends_a: np.ndarray
    ends_b: np.ndarray
    own_a: int
    own_b: int
    begin: int


def piece_of(a: np.ndarray, b: np.ndarray, ends_a: np.ndarray, ends_b: np.ndarray, at: tuple[int, int, int, int]) -> Piece:
    i, i2, j, j2 = at
    begin = max(ends_a[i - 1] if i else 0, ends_b[j - 1] if j else 0)
    return Piece(a[i : i2 + 1], b[j : j2 + 1], ends_a[i : i2 + 1], ends_b[j : j2 + 1], i2 - i, j2 - j, int(begin))


def overlaps(p: Piece) -> np.ndarray:
    """Pairs of ids, one for each stretch that ends in the piece: with each end the tokens of both kinds that it lies in."""
    ends_a, ends_b = p.ends_a[: p.own_a], p.ends_b[: p.own_b]
    first = p.a[: p.own_a] * PAIR + p.b[np.searchsorted(p.ends_b, ends_a)]
    at = np.searchsorted(p.ends_a, ends_b)
    # An end that both have is counted with a's, which may be the last one before the cut.
    alone = ends_b > p.begin
    alone[at < len(p.ends_a)] &= p.ends_a[at[at < len(p.ends_a)]] != ends_b[at < len(p.ends_a)]
    return np.concatenate([first, p.a[at[alone]] * PAIR + p.b[: p.own_b][alone]])


def common_ends(p: Piece) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of own ids of a and of b up to each end of a group that lies in the piece.

    An end that both have belongs to the piece of b's, which comes second; a's may be the last one before."""
    ends_b = p.ends_b[: p.own_b]
    at = np.searchsorted(p.ends_a[: p.own_a], ends_b)
    inside = p.ends_a[np.minimum(at, len(p.ends_a) - 1)] == ends_b if len(p.ends_a) else np.zeros(len(ends_b), bool)
    inside &= at < p.own_a
    before = (ends_b == p.begin) & ~inside
    shared = np.flatnonzero(inside | before)
    return np.where(inside, at + 1, 0)[shared], shared + 1


@dataclass(frozen=True)
class Groups:
    """What a piece has of groups, as text: ids of a and of b before its first common end, the groups between its first and
    last one and their number, ids after its last one. Without a common end everything stands in the tails."""

    head_a: str
    head_b: str
    inner: str
    n_inner: int
    tail_a: str
    tail_b: str


def groups_of(p: Piece, names: Names) -> Groups:
    a, b = p.a[: p.own_a], p.b[: p.own_b]
    to_a, to_b = common_ends(p)
    if not len(to_a):
        return Groups("", "", "", 0, names.listed("a", a), names.listed("b", b))
    inner = names.groups(a[to_a[0] : to_a[-1]], b[to_b[0] : to_b[-1]], to_a[1:] - to_a[0], to_b[1:] - to_b[0])
    heads = names.listed("a", a[: to_a[0]]), names.listed("b", b[: to_b[0]])
    return Groups(*heads, inner, len(to_a) - 1, names.listed("a", a[to_a[-1] :]), names.listed("b", b[to_b[-1] :]))


def stitch(parts: Iterable[Groups]) -> tuple[str, int]:
    """All groups of a text from those of its pieces in order, and their number."""
    texts: list[str] = []
    open_a: list[str] = []
    open_b: list[str] = []
    n = 0
    for g in parts:
        # Up to a common end there is an id of b at least.
        if g.head_b:
            open_a, open_b = [*open_a, g.head_a], [*open_b, g.head_b]
            texts += ["|".join(",".join(filter(None, side)) for side in (open_a, open_b)), g.inner]
            n += 1 + g.n_inner
            open_a, open_b = [g.tail_a], [g.tail_b]
        else:
            open_a.append(g.tail_a)
            open_b.append(g.tail_b)
    return ";".join(filter(None, texts)), n


def _counted(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    pairs, times = np.unique(codes, return_counts=True)
    return pairs, times.astype(np.int32), len(codes)


def _lists(parts: list, kind) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int32)
    values = np.concatenate(parts) if parts else np.zeros(0)
    return pa.ListArray.from_arrays(ends, pa.array(values, kind))


def _encoded(rows: DataFrame, vocabulary: Vocabulary, piece: int) -> DataFrame:
    """Of ``rows`` (row, number, text) a row for each piece: (row, number, piece, pieces, n_a, n_b); of a text of one
    piece its links and groups, of others what a piece needs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        *_, tokens_a, tokens_b, names = _tokenizers(vocabulary)
        empty = np.zeros(0, np.int64)
        for batch in batches:
            owner: list[int] = []
            found: list[tuple] = []
            for i, body in enumerate(text_column(batch.column(2))):
                a, b = encode_both(body.as_py(), vocabulary)
                ends_a, ends_b = tokens_a.ends(a), tokens_b.ends(b)
                parts = cut(ends_a, ends_b, piece)
                for k, at in enumerate(parts):
                    p = piece_of(a, b, ends_a, ends_b, at)
                    start_a, start_b = (int(ends[first - 1]) if first else 0 for ends, first in ((ends_a, at[0]), (ends_b, at[2])))
                    raw = p.a, p.b, p.own_a, p.own_b, start_a, start_b, p.begin
                    own: tuple = empty, empty, 0, 0, ""
                    if len(parts) == 1:
                        joined, n_groups = stitch([groups_of(p, names)])
                        own = *_counted(overlaps(p)), n_groups, hashlib.sha256(joined.encode()).hexdigest()
                        raw = empty, empty, 0, 0, 0, 0, 0
                    found.append((k, len(parts), len(a), len(b), *own, *raw))
                if not parts:
                    found.append((0, 1, 0, 0, empty, empty, 0, 0, "", empty, empty, 0, 0, 0, 0, 0))
                owner += [i] * max(len(parts), 1)
            at_row = pa.array(owner, pa.int64())
            yield _batch([batch.column(0).take(at_row), batch.column(1).take(at_row)], found, schema)

    links = dict(codes="array<bigint>", times="array<int>", n_links="bigint", n_groups="bigint", groups_sha256="string")
    raw = dict(a="array<int>", b="array<int>", own_a="int", own_b="int", start_a="bigint", start_b="bigint", begin="bigint")
    schema = extended(rows.select("row", "number").schema, piece="int", pieces="int", n_a="bigint", n_b="bigint", **links, **raw)
    return rows.mapInArrow(run, schema)


def _batch(first: list[pa.Array], rows: list[tuple], schema) -> pa.RecordBatch:
    """``first`` columns as they are, followed by those of ``rows``; lists of numbers come as numpy arrays."""
    from pyspark.sql.pandas.types import to_arrow_type

    fields = schema.fields[len(first) :]
    out = list(first)
    for field, values in zip(fields, zip(*rows) if rows else [()] * len(fields)):
        kind = to_arrow_type(field.dataType)
        numbers = pa.types.is_list(kind) and pa.types.is_integer(kind.value_type)
        out.append(_lists(values, kind.value_type) if numbers else pa.array(values, kind))
    return pa.RecordBatch.from_arrays(out, names=schema.names)


def _aligned(pieces: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """(number, piece, codes, times, n_links, groups) of the pieces of long texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        *_, tokens_a, tokens_b, names = _tokenizers(vocabulary)
        for batch in batches:
            column = dict(zip(batch.schema.names, batch.columns))
            found = []
            for i in range(batch.num_rows):
                a, b = (column[c][i].values.to_numpy().astype(np.int64) for c in "ab")
                own_a, own_b, start_a, start_b, begin = (column[c][i].as_py() for c in ("own_a", "own_b", "start_a", "start_b", "begin"))
                p = Piece(a, b, tokens_a.ends(a, start_a), tokens_b.ends(b, start_b), own_a, own_b, begin)
                found.append((*_counted(overlaps(p)), asdict(groups_of(p, names))))
            yield _batch([column["number"], column["piece"]], found, schema)

    groups = "struct<head_a:string,head_b:string,inner:string,n_inner:bigint,tail_a:string,tail_b:string>"
    schema = extended(pieces.select("number", "piece", "codes", "times", "n_links").schema, groups=groups)
    return pieces.select("number", "piece", "a", "b", "own_a", "own_b", "start_a", "start_b", "begin").mapInArrow(run, schema)


def _stitched(aligned: DataFrame) -> DataFrame:
    """(number, n_links, n_groups, groups_sha256) of the long texts. What comes together is the ids of one text."""
    part = F.struct("piece", "groups")
    grouped = aligned.groupBy("number").agg(F.sum("n_links").alias("n_links"), F.array_sort(F.collect_list(part)).alias("parts"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for parts in batch.column(2):
                joined, n = stitch(Groups(**p["groups"].as_py()) for p in parts.values) if parts.is_valid else ("", 0)
                found.append((n, hashlib.sha256(joined.encode()).hexdigest()))
            yield _batch([batch.column(0), batch.column(1)], found, schema)

    schema = extended(grouped.select("number", "n_links").schema, n_groups="bigint", groups_sha256="string")
    return grouped.mapInArrow(run, schema)


def pair_counts(links: DataFrame) -> DataFrame:
    """(code, count, best): how many overlaps of the corpus have the pair; whether it is the most common of its second id."""
    pairs = links.select(F.explode(F.arrays_zip("codes", "times")).alias("p"))
    counts = pairs.groupBy(F.col("p.codes").alias("code")).agg(F.sum("p.times").alias("count"))
    counts = written(counts, "pair-counts")
    second = F.col("code") % PAIR
    highest = counts.groupBy(second.alias("b")).agg(F.max("count").alias("highest"))
    # A row for each id of the second vocabulary.
    joined = counts.withColumn("b", second).join(F.broadcast(highest), "b")
    return joined.select("code", "count", (F.col("count") == F.col("highest")).alias("best"))


def _sums(links: DataFrame, counts: DataFrame) -> DataFrame:
    """(number, n_best, count_sum) of each text with overlaps."""
    pairs = links.select("number", F.explode(F.arrays_zip("codes", "times")).alias("p")).select(
        "number", F.col("p.codes").alias("code"), F.col("p.times").alias("times")
    )
    weight = F.col("times").cast("bigint")
    sums = [F.sum(F.when(F.col("best"), weight).otherwise(F.lit(0))).alias("n_best"), F.sum(weight * F.col("count")).alias("count_sum")]
    if counts.count() <= BROADCAST_ROWS:
        return pairs.join(F.broadcast(counts), "code").groupBy("number").agg(*sums)
    common = written(counts.orderBy(F.desc("count"), "code").limit(BROADCAST_ROWS), "pair-common")
    rest = counts.join(F.broadcast(common.select("code")), "code", "left_anti")
    known = pairs.join(F.broadcast(common), "code")
    other = pairs.join(F.broadcast(common.select("code")), "code", "left_anti").join(rest.hint("shuffle_hash"), "code")
    return known.unionByName(other).groupBy("number").agg(*sums)


def align_tokenizers(
    docs: DataFrame, vocabulary: Vocabulary, text: str = "text", keep: Sequence[str] | None = None, piece: int = PIECE
) -> tuple[DataFrame, DataFrame]:
    """The texts and the pairs.

    Texts: a struct ``row`` with the columns ``keep`` of ``docs`` (all by default), and ``n_a``, ``n_b``,
    ``n_groups``, ``n_links``, ``n_best`` (overlaps whose pair is the most common of its second id), ``count_sum``
    (sum over overlaps of the count of their pair), ``groups_sha256`` ('' without tokens). Pairs: (a, b, count, best).
    """
    carried = F.struct(*[F.col(f"`{c}`") for c in (docs.columns if keep is None else keep)])
    rows = docs.select(carried.alias("row"), F.monotonically_increasing_id().alias("number"), F.col(f"`{text}`").alias("text"))
    encoded = written(_encoded(rows, vocabulary, piece), "encoded")
    short, long = encoded.where("pieces = 1"), encoded.where("pieces > 1")
    aligned = written(_aligned(long.repartition("number", "piece"), vocabulary), "aligned")
    links = ["number", "codes", "times"]
    every = short.select(*links).unionByName(aligned.select(*links))
    counts = written(pair_counts(every), "pairs")
    found = ["row", "number", "n_a", "n_b", "n_links", "n_groups", "groups_sha256"]
    stitched = long.where("piece = 0").select("row", "number", "n_a", "n_b").join(_stitched(aligned), "number")
    whole = short.select(*found).unionByName(stitched.select(*found))
    joined = whole.join(_sums(every, counts), "number", "left")
    zero = F.lit(0).cast("bigint")
    texts = joined.select(
        "row", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", zero).alias("n_best"), F.coalesce("count_sum", zero).alias("count_sum"), "groups_sha256"
    )
    pairs = counts.select(F.shiftright("code", 31).cast("int").alias("a"), (F.col("code") % PAIR).cast("int").alias("b"), "count", "best")
    return texts, pairs
