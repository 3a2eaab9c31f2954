"""Best-fit packing of tokenised documents into fixed-length sequences, planned on the length histogram."""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left, insort
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from math import ceil

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from judgeset.llm._tables import Scratch, table, tidy

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
#: Characters that Python's split() takes for white space and the tokenizer does not.
_CONTROL = re.compile("[\x1c-\x1f]")
_OTHER_SPACE = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")
#: Words whose ids a Python worker remembers; others are encoded anew.
_REMEMBERED = 250_000
#: Code points from here on may change under normalisation together with others; such words go through the whole tokenizer.
_PLAIN = re.compile("[^\u0300-\U0010ffff]*")
#: The tokenizer's own rule for parts of words (a fixed value).
_PARTS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
_known: dict[str, dict[str, bytes]] = {}
_known_parts: dict[str, dict[str, bytes]] = {}
_tokenizers: dict = {}


def _byte_letters() -> dict[int, str]:
    """Byte-level letters: printable bytes stand for themselves, the others follow from 256 in order."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(rest)}


_LETTERS = "".join(_byte_letters()[b] for b in range(256))


def _tokenizer(path: str):
    if path not in _tokenizers:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        _tokenizers[path] = Tokenizer.from_file(path)
    return _tokenizers[path]


def _part_ids(path: str) -> Callable[[str], bytes]:
    """Ids of a part of a word in lower case, remembered: words with marks around them share their parts."""
    merge, known = _tokenizer(path).model.tokenize, _known_parts.setdefault(path, {})

    def ids(part: str) -> bytes:
        got = known.get(part)
        if got is None:
            letters = part if part.isascii() and part.isprintable() else part.encode().decode("latin-1").translate(_LETTERS)
            got = b"".join([t.id.to_bytes(4, "little") for t in merge(letters)])
            if len(known) < _REMEMBERED:
                known[part] = got
        return got

    return ids


def _word_ids(words: list[str], path: str) -> dict[str, bytes]:
    """Ids of single words. Plain words need only lower case, the parts rule and the vocabulary's merges."""
    tokenizer, part_ids, got, other = _tokenizer(path), _part_ids(path), {}, []
    for w in words:
        if "<|" in w or not (w.isascii() or _PLAIN.fullmatch(w)):
            other.append(w)
            continue
        low = w.lower()
        if low.isalpha():
            got[w] = part_ids(low)
        elif low[-1] in ".,;:!?" and low[:-1].isalpha():
            got[w] = part_ids(low[:-1]) + part_ids(low[-1])
        else:
            got[w] = b"".join([part_ids(part) for part in _PARTS.findall(low)])
    for at in range(0, len(other), 5000):
        part = other[at : at + 5000]
        for w, e in zip(part, tokenizer.encode_batch(part, add_special_tokens=False), strict=True):
            got[w] = np.asarray(e.ids, dtype="<u4").tobytes()
    return got


def encode_words(texts: list[str], path: str) -> list[bytes]:
    """Ids of each text as little-endian unsigned 32-bit numbers.

    The tokenizer drops white space and no token spans it, so a text's ids are its words' ids in order: words are
    encoded once and looked up after that.
    """
    known = _known.setdefault(path, {})
    split = [t.split() if not _CONTROL.search(t) else [w for w in _OTHER_SPACE.split(t) if w] for t in texts]
    got = _word_ids(list({w for words in split for w in words if w not in known}), path)
    if len(known) + len(got) <= _REMEMBERED:
        known.update(got)
        return [b"".join([known[w] for w in words]) for words in split]
    return [b"".join([known[w] if w in known else got[w] for w in words]) for words in split]


def tokenize_pieces(df: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text", capacity: int = 4096, end_id: int = 1) -> DataFrame:
    """One row per piece: documents (ids, then end_id) longer than capacity are cut into pieces of capacity tokens."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        end = int(end_id).to_bytes(4, "little")
        for batch in batches:
            for at in range(0, len(batch), 256):
                ids, texts = batch["doc_id"].iloc[at : at + 256].tolist(), batch["text"].iloc[at : at + 256].tolist()
                rows = []
                for d, got in zip(ids, encode_words([t or "" for t in texts], tokenizer), strict=True):
                    got += end
                    for k, s in enumerate(range(0, len(got), 4 * capacity)):
                        part = got[s : s + 4 * capacity]
                        rows.append((d, k, s // 4, len(part) // 4, zlib.crc32(part)))
                out = pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32"])
                yield out.astype({"doc_id": "Int64"})

    return df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInPandas(tidy(cut), PIECES)


def knapsack(value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unbounded knapsack over sizes 1..C: the best value for every capacity, and the last size taken (0: none)."""
    c = len(value) - 1
    best, last = np.zeros(c + 1, np.float32), np.zeros(c + 1, np.int32)
    value = value.astype(np.float32)
    for room in range(1, c + 1):
        total = value[1 : room + 1] + best[room - 1 :: -1] if room > 1 else value[1:2] + best[:1]
        k = int(total.argmax())
        if total[k] > 0:
            best[room], last[room] = total[k], k + 1
        if best[room - 1] > best[room]:
            best[room], last[room] = best[room - 1], -1  # leave one token free
    return best, last


def _taken(last: np.ndarray, room: int) -> list[int]:
    out = []
    while room > 0 and last[room]:
        size = int(last[room])
        if size > 0:
            out.append(size)
        room -= size if size > 0 else 1
    return out


@dataclass(frozen=True)
class Fractional:
    """A solution of the configuration LP: how often each configuration, ((length, number in it), ...), is used; what is
    left of each length's demand; the number of bins with that rest packed too; and a lower bound on any packing."""

    columns: dict[tuple[tuple[int, int], ...], float]
    rest: dict[int, float]
    primal: float
    dual: float


def configuration_lp(histogram: dict[int, int], capacity: int, rounds: int = 150, columns: int = 256, rate: float = 6.0, step: float = 0.25, near: float = 0.01) -> Fractional:
    """min bins, such that the configurations cover every length as often as it occurs, by multiplicative weights.

    A length's price starts at its share of the capacity and falls exponentially with the share of its demand already
    covered. Each round one knapsack dynamic program finds the best configuration at these prices and the best through
    each length; of those through the most needed lengths, all within near of the best overall enter with step of what
    their scarcest length still needs. Prices over all lengths, divided by the best configuration's, are feasible in
    the dual, so their worth is a lower bound. A rest of a thousandth is left to best-fit decreasing. Work depends on
    the capacity alone, not on the number of pieces.
    """
    demand = np.zeros(capacity + 1)
    for size, n in histogram.items():
        demand[size] = n
    there, first, share = demand > 0, np.maximum(demand, 1), np.arange(capacity + 1) / capacity
    need, dual, found = demand.copy(), 0.0, {}
    for t in range(rounds):
        if (need * share).sum() <= 1e-3 * (demand * share).sum():
            break
        price = share * np.exp(-rate * (1 - need / first))
        if t % 10 == 0:
            best, _ = knapsack(np.where(there, price, -np.inf))
            dual = max(dual, float((demand * price).sum() / best[capacity]) * (1 - 1e-6))  # of 32-bit sums
        left = need > 1e-9 * first
        best, last = knapsack(np.where(left, price, -np.inf))
        order = np.flatnonzero(left)
        order = order[np.argsort(-(need[order] / first[order]) * share[order], kind="stable")][:columns]
        moved = False
        for size in order.tolist():
            if need[size] <= 1e-9 * first[size] or price[size] + best[capacity - size] < (1 - near) * best[capacity]:
                continue
            made, number = np.unique([size, *_taken(last, capacity - size)], return_counts=True)
            times = step * float((need[made] / number).min())
            if times > 0:
                need[made] -= times * number
                config = tuple(zip(made.tolist(), number.tolist(), strict=True))
                found[config] = found.get(config, 0.0) + times
                moved = True
        near = near if moved else min(1.0, 2 * near)
    rest = {int(s): float(need[s]) for s in np.flatnonzero(need > 1e-9 * first)}
    packed = best_fit_decreasing({s: ceil(1000 * n) for s, n in rest.items()}, capacity)
    return Fractional(found, rest, sum(found.values()) + sum(times for times, _ in packed) / 1000, dual)


def rounded(histogram: dict[int, int], columns: dict[tuple[tuple[int, int], ...], float]) -> tuple[list[tuple[int, list[tuple[int, int]]]], dict[int, int]]:
    """Bins as (multiplicity, [(length, number per bin)]), and the lengths left over: configurations in falling order,
    each rounded down, but once at least, as far as what is left of its lengths allows."""
    left, bins = dict(histogram), []
    for config, times in sorted(columns.items(), key=lambda x: (-x[1], x[0])):
        whole = min([max(1, int(times)), *[left[s] // k for s, k in config]])
        if whole > 0:
            for s, k in config:
                left[s] -= whole * k
            bins.append((whole, list(config)))
    return bins, {s: n for s, n in left.items() if n}


def configured(histogram: dict[int, int], capacity: int, again: int = 2, rounds: int = 60, enough: float = 0.02) -> tuple[list[tuple[int, list[tuple[int, int]]]], dict[int, int]]:
    """Bins from the configuration LP, and the lengths left over. What rounding leaves is a smaller problem of the same
    kind: its LP is solved and rounded in turn, up to again times with so many rounds each, or until at most enough of
    all tokens are left."""
    size = lambda h: sum(s * n for s, n in h.items())
    bins, left = rounded(histogram, configuration_lp(histogram, capacity).columns)
    for _ in range(again):
        if size(left) <= enough * size(histogram):
            break
        more, left = rounded(left, configuration_lp(left, capacity, rounds).columns)
        bins += more
    return bins, left


def best_fit_decreasing(histogram: dict[int, int], capacity: int, bins: Iterable[tuple[int, list[tuple[int, int]]]] = ()) -> list[tuple[int, list[tuple[int, int]]]]:
    """Best-fit decreasing on a histogram, into the room that bins leave and into new ones; equal bins are handled
    together."""
    open_: dict[int, list[tuple[int, tuple]]] = {}
    rooms: list[int] = []

    def put(room: int, times: int, held: tuple) -> None:
        if room not in open_:
            open_[room] = []
            insort(rooms, room)
        open_[room].append((times, held))

    for times, held in bins:
        put(capacity - sum(s * k for s, k in held), times, tuple(held))
    for size in sorted(histogram, reverse=True):
        left = histogram[size]
        while left:
            at = bisect_left(rooms, size)
            room = rooms[at] if at < len(rooms) else capacity
            if at < len(rooms):
                times, held = open_[room].pop()
                if not open_[room]:
                    del open_[room]
                    rooms.pop(at)
            else:
                times, held = ceil(left / (capacity // size)), ()
            each = min(room // size, left)
            used = min(times, left // each)
            if times > used and held:
                put(room, times - used, held)
            put(room - each * size, used, (*held, (size, each)))
            left -= used * each
    return [(times, list(held)) for group in open_.values() for times, held in group]


def plan_bins(histogram: dict[int, int], capacity: int) -> pd.DataFrame:
    """Where the r-th piece of each length goes: for lo <= r < hi, sequence base + (r - lo) % times."""
    bins, rest = configured(histogram, capacity)
    bins = best_fit_decreasing(rest, capacity, bins)
    at, base, rows = dict.fromkeys(histogram, 0), 0, []
    for times, held in bins:
        offset = 0
        for size, each in sorted(held, reverse=True):
            rows.append((size, at[size], at[size] + times * each, times, base, offset))
            at[size] += times * each
            offset += size * each
        base += times
    return pd.DataFrame(rows, columns=["length", "lo", "hi", "times", "base", "place"]).astype("int64")


def pack(pieces: DataFrame, capacity: int = 4096, rows_per_task: int = 250_000) -> DataFrame:
    """Adds sequence_id and offset to pieces (columns as in PIECES; lengths from 1 to capacity).

    Only the histogram (at most capacity rows) reaches the driver. Pieces of one length are ranked in salted groups of
    about rows_per_task whose ranks follow on from each other, so a length that a third of all pieces have is spread
    over as many tasks as it needs. Repeated rows are pieces of their own. An empty table gives no rows.
    """
    spark = pieces.sparkSession
    scratch = Scratch(spark, "packing")
    pieces = scratch.keep(pieces, "pieces")
    histogram = {int(r["length"]): int(r["count"]) for r in pieces.groupBy("length").count().collect()}
    plan = plan_bins(histogram, capacity)
    bins = spark.createDataFrame(plan, "length long, lo long, hi long, times long, base long, place long")
    split = spark.createDataFrame([(s, ceil(n / rows_per_task)) for s, n in histogram.items()], "length long, salts long")
    salted = pieces.join(F.broadcast(split), "length").withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece"), F.col("salts"))).drop("salts")
    before = salted.groupBy("length", "salt").count().select("length", "salt", (F.sum("count").over(W.partitionBy("length").orderBy("salt")) - F.col("count")).alias("before"))
    order = W.partitionBy("length", "salt").orderBy("doc_id", "piece", "start", "ids_crc32")
    ranked = salted.withColumn("r", F.row_number().over(order) - 1).join(before, ["length", "salt"]).withColumn("r", F.col("r") + F.col("before"))
    # at most (rounds * columns) configurations of each LP and a few bins per length, whatever the number of pieces
    placed = ranked.join(F.broadcast(bins), (ranked["length"] == bins["length"]) & (F.col("r") >= F.col("lo")) & (F.col("r") < F.col("hi")))
    step = F.col("r") - F.col("lo")
    return placed.select(
        "doc_id", "piece", "start", ranked["length"], "ids_crc32",
        (F.col("base") + step % F.col("times")).alias("sequence_id"),
        (F.col("place") + F.floor(step / F.col("times")) * ranked["length"]).alias("offset"),
    )


def pack_documents(df: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text", capacity: int = 4096, end_id: int = 1) -> DataFrame:
    """Tokenises and packs documents. Null texts count as empty (one token, end_id); null ids are kept; repeated rows
    are packed once each; texts of any length are cut into pieces; other columns are not read."""
    return pack(tokenize_pieces(df, tokenizer, doc_id, text, capacity, end_id), capacity)


def default_tokenizer() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("word_bpe_49k.json"))


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), default_tokenizer())
