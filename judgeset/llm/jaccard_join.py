"""N-gram Jaccard join: parity sketches, pigeonhole join per size band, exact verification.

The parity sketch of a set has one bit for every 64-bit shingle hash: the parity of the shingles that hash there. Two
sketches differ in no more bits than their sets differ in shingles. The full sketch is kept sparse, as its odd
positions, and dense ones of a few bits per shingle are its folds, which only bring the distance down further. The
sparse sketches are joined by pigeonhole, and the folds rule pairs out before any set is looked at.

Pigeonhole: sets of n <= m shingles with Jaccard similarity of 3/4 share o = 3/7 (n + m) positions or more, so of the
first n - o + 1 positions of the smaller, in any order that holds for all sets, and of the first m - o + 1 of the larger,
one is common. n - o is at most n / 7 and m - o at most m / 4: each set signs with its first m / 4 + 1 positions, those
that few sets have first. A pair counts only at its first common position, whose ranks in both sets must obey the
bounds for their very sizes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from judgeset.llm._components import components
from judgeset.llm._hashing import mix, shingles, slices
from judgeset.llm._tables import Scratch, table, tidy

WIDTH, PERCENT = 5, 75
#: Least bits of a folded sketch; large sets get two bits or more per shingle.
SKETCH_BITS = 1024
#: How many sets have a shingle is counted for shingles that COMMON sets or more have. An array of 2^CELLS cells keeps
#: its logarithm, the largest where several shingles meet. Its size never changes; the least logarithm in it rises with
#: the corpus, so that one cell of ROOM at most is in use. A wrong order costs nothing but time.
COMMON, CELLS, ROOM = 4, 24, 8
HELD = 3_000_000
#: Runs of more sets with one position are linked in a star first; see _grouped.
RUN = 16
#: Sets of such a run that are compared with each other in one piece.
BLOCK = 2048
#: Rows of 24 bytes each that are broadcast, to find texts by their hashes or to drop rows; beyond that texts are shuffled.
SENT = 1_000_000


def _texts(batch: pd.DataFrame) -> list[bytes]:
    return [t.encode("utf-8", "surrogatepass") if isinstance(t, str) else b"" for t in batch["text"]]


def _of(begins: np.ndarray) -> np.ndarray:
    return np.repeat(np.arange(len(begins) - 1), np.diff(begins))


def _classes(value: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """One number per set: the same for the same set."""
    n = np.diff(begins)
    out = np.zeros(len(n), np.uint64)
    some = n > 0
    if some.any():
        at = begins[:-1][some]
        out[some] = mix(np.bitwise_xor.reduceat(mix(value), at) + np.uint64(3) * mix(np.add.reduceat(value, at) + n[some].astype(np.uint64)))
    return out.view(np.int64)


def _sketch(value: np.ndarray) -> bytes:
    """The sketch of one set folded to SKETCH_BITS, or to at least two bits per shingle: bit b is the parity of its
    shingles that are b modulo the number of bits."""
    bits = max(SKETCH_BITS, 1 << (2 * len(value) - 1).bit_length()) if len(value) else SKETCH_BITS
    return np.packbits((np.bincount((value & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1).astype(np.uint8)).tobytes()


DESCRIBED = "kind int, doc_id long, ta long, tb long, n long, class long, sketch binary, shingle long, docs long"


def _described(kind: int, columns: dict) -> pd.DataFrame:
    """Rows of DESCRIBED with the given columns; the others are null."""
    null = pd.array([None] * len(next(iter(columns.values()))), "Int64")
    names = [c.split()[0] for c in DESCRIBED.split(", ")]
    return pd.DataFrame({c: kind if c == "kind" else columns.get(c, None if c == "sketch" else null) for c in names})


def _shared(held: list[np.ndarray]) -> Iterator[pd.DataFrame]:
    """Shingles that are there twice or more, as rows of DESCRIBED. Empties held."""
    value = np.concatenate(held) if held else np.zeros(0, np.uint64)
    held.clear()
    value.sort()
    first = np.flatnonzero(np.append(True, value[1:] != value[:-1])) if len(value) else np.zeros(0, np.int64)
    docs = np.diff(np.append(first, len(value)))
    number, docs = value[first][docs > 1], docs[docs > 1]
    for at in range(0, len(number), 50_000):
        part = number[at : at + 50_000]
        yield _described(1, {"shingle": part.view(np.int64), "docs": docs[at : at + 50_000]})


def _describe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows of documents (kind 0: size, class, sketch), and of shingles that two different sets have (kind 1: shingle,
    docs), counted in portions of about HELD shingles."""
    seen, held = np.zeros(0, np.int64), []
    for batch in batches:
        texts = _texts(batch)
        for i, j in slices(texts):
            part = batch.iloc[i:j]
            value, begins = shingles(texts[i:j], WIDTH)
            kinds = _classes(value, begins)
            sketches = [_sketch(value[x:y]) for x, y in zip(begins[:-1], begins[1:], strict=True)]
            yield _described(0, {"doc_id": part["doc_id"].astype("Int64").array, "ta": part["ta"].to_numpy(), "tb": part["tb"].to_numpy(), "n": np.diff(begins), "class": kinds, "sketch": sketches})
            once = np.zeros(len(kinds), bool)
            once[np.unique(kinds, return_index=True)[1]] = True
            once &= ~np.isin(kinds, seen)
            seen = np.union1d(seen, kinds)
            held.append(value[once[_of(begins)]])
            if sum(map(len, held)) > HELD:
                yield from _shared(held)
                seen = np.zeros(0, np.int64)
    yield from _shared(held)


def _least(per: dict[int, int], room: int) -> int:
    """The smallest logarithm from which on the shingles, per[log] of each, are no more than room. The largest one always
    stays, so that the most frequent shingles come last whatever their number."""
    for log in sorted(per):
        if sum(n for at, n in per.items() if at >= log) <= room:
            return log
    return max(per, default=0)


def _levels(shared: DataFrame, scratch: Scratch) -> np.ndarray:
    """The array of cells, four bits each, sixteen to a number: 0 for rare shingles, else the logarithm of how many sets
    have them, from the least that is kept. 2^(CELLS - 4) numbers at most reach the driver, whatever the input.

    A shingle outside the array is in fewer than 2^least sets of those counted, so a position that many sets share has a
    cell in use, and such positions sign last.
    """
    counted = shared.groupBy("shingle").agg(F.sum("docs").alias("docs")).filter(F.col("docs") >= COMMON)
    counted = scratch.keep(counted.select("shingle", F.floor(F.log2("docs")).cast("long").alias("log")), "counted")
    per = {r["log"]: r["count"] for r in counted.groupBy("log").count().collect()}  # 64 rows at most
    least = _least(per, (1 << CELLS) // ROOM)
    level = F.least(F.col("log") - least + 1, F.lit(15))
    cells = counted.filter(F.col("log") >= least).groupBy(F.expr(f"shingle & {(1 << CELLS) - 1}").alias("cell")).agg(F.max(level).alias("level"))
    words = cells.groupBy(F.shiftright("cell", 4).alias("word")).agg(F.bit_or(F.expr("shiftleft(level, cast(4 * (cell & 15) as int))")).alias("levels")).toPandas()
    out = np.zeros(1 << (CELLS - 4), np.uint64)
    out[words["word"].to_numpy(np.int64)] = words["levels"].to_numpy(np.int64).view(np.uint64)
    scratch.drop(counted)
    return out


def level_of(value: np.ndarray, levels: np.ndarray) -> np.ndarray:
    cell = value & np.uint64(16 * len(levels) - 1)
    return ((levels[cell >> np.uint64(4)] >> (np.uint64(4) * (cell & np.uint64(15)))) & np.uint64(15)).astype(np.uint8)


def signatures(value: np.ndarray, begins: np.ndarray, levels: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Set, position, rank and the position before of each set's first n / 4 + 1 positions, ordered by level and then by
    the position itself."""
    of, n = _of(begins), np.diff(begins)
    value = value[np.lexsort((value, level_of(value, levels), of))]
    rank = np.arange(len(value)) - begins[:-1][of]
    before = np.zeros(len(value), np.uint64)
    before[1:] = value[:-1]
    before[rank == 0] = 0
    chosen = rank <= n[of] // 4
    return of[chosen], value[chosen], rank[chosen].astype(np.int32), before[chosen].view(np.int64)


MEMBER = ["key", "class", "n", "rank", "before"]
RUNS = "a long, b long, key long, class long, n int, rank int, before long"


def _first_common(x: dict[str, np.ndarray], y: dict[str, np.ndarray]) -> np.ndarray:
    """Whether x and y, who share a position, may be similar and share none before. Where both have the same position
    before it (and are not at their first, rank 0) they meet there. Bands of size: 3/4 to 4/3."""
    n, m = x["n"].astype(np.int64), y["n"].astype(np.int64)
    o = -(-3 * (n + m) // 7)
    return (4 * np.minimum(n, m) >= 3 * np.maximum(n, m)) & (x["rank"] <= n - o) & (y["rank"] <= m - o) & ((x["before"] != y["before"]) | ((x["rank"] == 0) & (y["rank"] == 0)))


def _runs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """From rows of MEMBER sorted by key, rank and class: candidate pairs (a, b), and the members of long runs (key and on).

    A run of at most RUN classes gives its pairs, a longer one its members and a star around its first class: the one
    with the fewest positions before, that is with the least of its own, such as the original of edited copies. Streams
    over the rows; between batches it holds the RUN rows of an open run, or the first of a long one.
    """
    carried: pd.DataFrame | None = None
    centre: tuple[int, int, int] | None = None  # key, class and size at the start of an open long run

    def found(columns: dict) -> pd.DataFrame:
        n = len(next(iter(columns.values())))
        return pd.DataFrame({c: columns.get(c, pd.array([None] * n, "Int64")) for c in ("a", "b", *MEMBER)})

    def pairs(x: pd.DataFrame, begin: np.ndarray, length: np.ndarray) -> Iterator[pd.DataFrame]:
        short = (length > 1) & (length <= RUN)
        at = np.repeat(begin[short], length[short]) + np.arange(length[short].sum()) - np.repeat(np.cumsum(length[short]) - length[short], length[short])
        run = np.repeat(np.arange(short.sum()), length[short])
        of = {c: x[c].to_numpy()[at] for c in MEMBER}
        a, b = [], []
        for step in range(1, min(RUN, len(at))):
            mine = run[step:] == run[:-step]
            if not mine.any():
                break
            left, right = ({c: v[s][mine] for c, v in of.items()} for s in (slice(None, -step), slice(step, None)))
            ok = _first_common(left, right)
            a.append(left["class"][ok]), b.append(right["class"][ok])
        if a and sum(map(len, a)):
            both = np.unique(np.stack([np.concatenate(a), np.concatenate(b)]), axis=1)
            yield found({"a": both[0], "b": both[1]})

    def star(x: pd.DataFrame) -> Iterator[pd.DataFrame]:
        yield found({c: x[c].to_numpy() for c in MEMBER})
        n = x["n"].to_numpy(np.int64)
        ok = (4 * np.minimum(n, centre[2]) >= 3 * np.maximum(n, centre[2])) & (x["class"].to_numpy() != centre[1])
        if ok.any():
            yield found({"a": np.full(ok.sum(), centre[1]), "b": x["class"].to_numpy()[ok]})

    for batch in batches:
        x = batch if carried is None else pd.concat([carried, batch], ignore_index=True)
        if not len(x):
            continue
        key, kind = x["key"].to_numpy(), x["class"].to_numpy()
        new = np.append(True, (key[1:] != key[:-1]) | (kind[1:] != kind[:-1]))
        x = x[new]
        key = x["key"].to_numpy()
        begin = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        length = np.diff(np.append(begin, len(key)))
        if centre is not None:
            if key[0] == centre[0]:
                yield from star(x.iloc[: length[0]])
                length[0] = 0
            if len(begin) > 1 or key[0] != centre[0]:
                centre = None
        for i in np.flatnonzero(length > RUN):
            first = x.iloc[begin[i]]
            centre = (int(first["key"]), int(first["class"]), int(first["n"]))
            yield from star(x.iloc[begin[i] : begin[i] + length[i]])
        open_long = length[-1] == 0 or length[-1] > RUN
        if not open_long:
            centre = None
        carried = None if open_long else x.iloc[begin[-1] :]
        yield from pairs(x, begin[:-1], length[:-1])
    if carried is not None:
        yield from pairs(carried, np.zeros(1, np.int64), np.array([len(carried)]))


def _row(doc_id: str, text: str) -> list[Column]:
    """What tells rows apart: the id, and the text by two hashes with different seeds."""
    return [F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(F.col(text)).alias("ta"), F.xxhash64(F.lit(7), F.col(text)).alias("tb")]


def _as_key() -> Column:
    """A row's place in the order in which the first row of a group is chosen: by id, rows without one last."""
    return F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "ta", "tb")


def _same_row(x: str, y: str) -> Column:
    return F.col(f"{x}doc_id").eqNullSafe(F.col(f"{y}doc_id")) & (F.col(f"{x}ta") == F.col(f"{y}ta")) & (F.col(f"{x}tb") == F.col(f"{y}tb"))


def near_duplicate_groups(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles and component_id (smallest id reachable by links) of every row.

    Two documents link if their sets of distinct five-word shingles (A-Z in lower case) have a Jaccard similarity of
    0.75 or more. Null and empty texts have no shingle and link with nothing. Rows with the same set, repeated rows
    among them, are one class from the start. Links go between classes, so that rows without id link like others and an
    id that stands for several texts does not join their groups. A group none of whose rows has an id has none either.
    Other columns are not read. An empty table gives no rows.
    """
    return _grouped(df, doc_id, text).select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("best.doc_id")).otherwise(F.col("doc_id")).alias("component_id"))


def first_of_near_duplicates(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """df with one row of each group of near_duplicate_groups, and every row without a shingle.

    The row with the smallest id stays, among several texts of one id that with the smallest hash, among repeated rows
    of one id and text the smallest by the columns in their order. Rows without id stay only where no row of the group
    has one. Any other columns are passed on; they must have an order.
    """
    scratch = Scratch(df.sparkSession, "first")
    rows = _grouped(df, doc_id, text).filter("n > 0").groupBy("doc_id", "ta", "tb").agg(F.max(_as_key() == F.col("best")).alias("stays"), F.count(F.lit(1)).alias("rows"))
    named = [F.col(c).alias(f"__{c}") for c in ("doc_id", "ta", "tb")]
    leave = scratch.keep(rows.filter("NOT stays OR rows > 1").select(*named, "stays"), "leave")
    marked = df.select(F.struct(*df.columns).alias("x"), *_row(doc_id, text))
    sent = F.broadcast if leave.count() <= SENT else lambda x: x
    out = marked.join(sent(leave), _same_row("", "__"), "left_anti").select("x.*")
    again = leave.filter("stays")
    if again.isEmpty():
        return out
    single = marked.join(sent(again), _same_row("", "__"), "left_semi").groupBy("doc_id", "ta", "tb").agg(F.min("x").alias("x"))
    return out.unionByName(single.select("x.*"))


def _grouped(df: DataFrame, doc_id: str, text: str) -> DataFrame:
    """doc_id, ta and tb (hashes of the text), n and best (the first row of the group, as _as_key has it) of every row.

    Where more than RUN classes share a position, each is first compared with one of them only (see _runs); members that
    are still in different components after that are compared in a second round, by rank and size, in blocks, so no link
    between components is lost and a large group of near copies never needs its pairs.
    """
    scratch = Scratch(df.sparkSession, "jaccard")
    texts = df.select(*_row(doc_id, text), F.col(text).alias("text"))
    documents, shared = scratch.split(texts.mapInPandas(tidy(_describe), DESCRIBED), "described", "kind", 2)
    documents = documents.drop("shingle", "docs")
    levels = df.sparkSession.sparkContext.broadcast(_levels(shared, scratch))
    scratch.drop(shared)

    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts, seen = _texts(batch), np.zeros(0, np.int64)
            for i, j in slices(texts):
                value, begins = shingles(texts[i:j], WIDTH)
                of, key, rank, before = signatures(value, begins, levels.value)
                kinds = _classes(value, begins)
                stays = np.zeros(len(kinds), bool)  # rows of one class in this batch sign once
                stays[np.unique(kinds, return_index=True)[1]] = True
                stays &= ~np.isin(kinds, seen)
                seen = np.union1d(seen, kinds)
                c = stays[of]
                of = of[c]
                yield pd.DataFrame({"key": key[c].view(np.int64), "class": kinds[of], "n": np.diff(begins)[of].astype(np.int32), "rank": rank[c], "before": before[c]})

    signed = texts.select("text").mapInPandas(tidy(sign), "key long, class long, n int, rank int, before long")
    runs = scratch.keep(signed.repartition("key").sortWithinPartitions("key", "rank", "class").mapInPandas(tidy(_runs), RUNS), "runs")
    classes = scratch.keep(documents.filter("n > 0").groupBy("class").agg(F.min(_as_key()).alias("rep"), F.min("n").alias("n"), F.min("sketch").alias("sketch")), "classes")
    links = _verified(texts, classes, runs.filter("key IS NULL").select("a", "b").distinct(), scratch)
    found = components(links, scratch)
    across = scratch.keep(_across(runs.filter("key IS NOT NULL").select(*MEMBER).distinct(), found, scratch), "across")
    scratch.drop(runs)
    if not across.isEmpty():
        second = _verified(texts, classes, across, scratch)
        if not second.isEmpty():
            found = components(links.unionByName(second), scratch)
    scratch.drop(across)

    found = found.withColumnRenamed("node", "class")
    best = found.join(classes.select("class", "rep"), "class").groupBy("component").agg(F.min("rep").alias("best"))
    of_class = classes.select("class", "rep").join(found.join(best, "component"), "class", "left").select("class", F.coalesce("best", "rep").alias("best"))
    return documents.join(of_class, (documents["class"] == of_class["class"]) & (documents["n"] > 0), "left").select("doc_id", "ta", "tb", "n", "best")


def _across(members: DataFrame, found: DataFrame, scratch: Scratch) -> DataFrame:
    """Pairs of members of one long run that are in different components and may be similar.

    Members of a run are dealt into blocks of about BLOCK, by size band (powers of 4/3) where one block would not hold
    them, and each pair of blocks of the same or neighbouring bands is one group of rows, so a long run spreads over
    many tasks. Runs whose members are all connected leave at once.
    """
    component = members.join(found.withColumnRenamed("node", "class"), "class", "left").withColumn("component", F.coalesce("component", "class"))
    component = scratch.keep(component, "members")
    sizes = component.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count(F.lit(1)).alias("members")).filter("lo < hi").select("key", "members")
    band = F.when(F.col("members") <= BLOCK, 0).otherwise(F.floor(F.log("n") / F.lit(float(np.log(4 / 3))))).cast("int")
    mixed = scratch.keep(component.join(sizes, "key").withColumn("band", band).drop("members"), "mixed")
    counted = mixed.groupBy("key", "band").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    per_key = counted.groupBy("key").agg(F.map_from_entries(F.collect_list(F.struct("band", "blocks"))).alias("blocks"))
    dealt = mixed.join(per_key, "key").withColumn("block", F.pmod(F.xxhash64("class"), F.element_at("blocks", F.col("band"))).cast("int"))
    # own band: with every block, the lower one first; neighbouring bands: with every block, the lower band first
    own = F.transform(F.sequence(F.lit(0), F.element_at("blocks", F.col("band")) - 1), lambda o: F.struct(F.col("band").alias("u"), F.least("block", o).alias("i"), F.col("band").alias("v"), F.greatest("block", o).alias("j"), (F.col("block") > o).alias("right")))

    def beside(step: int) -> Column:
        other = F.col("band") + step
        there = F.coalesce(F.element_at("blocks", other), F.lit(0))
        low, high = (F.col("band"), other) if step > 0 else (other, F.col("band"))
        return F.when(there > 0, F.transform(F.sequence(F.lit(0), there - 1), lambda o: F.struct(low.alias("u"), (F.col("block") if step > 0 else o).alias("i"), high.alias("v"), (o if step > 0 else F.col("block")).alias("j"), F.lit(step < 0).alias("right")))).otherwise(F.array().cast("array<struct<u:int,i:int,v:int,j:int,right:boolean>>"))

    group = ["key", "u", "i", "v", "j"]
    placed = dealt.withColumn("at", F.explode(F.concat(own, beside(1), beside(-1)))).select("key", "at.*", "class", "n", "rank", "before", "component")
    return placed.repartition(*group).sortWithinPartitions(*group).mapInPandas(tidy(_between), "a long, b long").distinct()


def _between(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Pairs of each group of rows sorted by key and pair of blocks; holds one group, of two blocks at most."""
    group = ["key", "u", "i", "v", "j"]

    def compared(x: pd.DataFrame) -> Iterator[pd.DataFrame]:
        same = (x["u"].iloc[0], x["i"].iloc[0]) == (x["v"].iloc[0], x["j"].iloc[0])
        left, right = (x, x) if same else (x[~x["right"]], x[x["right"]])
        y = {c: right[c].to_numpy()[None, :] for c in ("class", "n", "rank", "before", "component")}
        for at in range(0, len(left), 256):
            z = {c: left[c].to_numpy()[at : at + 256, None] for c in y}
            ok = _first_common(z, y) & (z["component"] != y["component"])
            if same:
                ok &= z["class"] < y["class"]
            i, j = np.nonzero(ok)
            if len(i):
                yield pd.DataFrame({"a": z["class"][i, 0], "b": y["class"][0, j]})

    held: list[pd.DataFrame] = []
    for batch in batches:
        if not len(batch):
            continue
        at = batch[group].to_numpy()
        begin = [0, *(np.flatnonzero((at[1:] != at[:-1]).any(axis=1)) + 1).tolist(), len(batch)]
        for s, e in zip(begin[:-1], begin[1:], strict=True):
            part = batch.iloc[s:e]
            if held and (held[0][group].iloc[0].to_numpy() != part[group].iloc[0].to_numpy()).any():
                yield from compared(pd.concat(held, ignore_index=True))
                held = []
            held.append(part)
    if held:
        yield from compared(pd.concat(held, ignore_index=True))


def _sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    seen: set[int] = set()
    for batch in batches:
        batch = batch.drop_duplicates("class")  # repeated rows of one id and text
        batch = batch[~batch["class"].isin(seen)]
        seen.update(batch["class"].tolist())
        texts = _texts(batch)
        for i, j in slices(texts):
            part = batch.iloc[i:j]
            value, begins = shingles(texts[i:j], WIDTH)
            out = pd.DataFrame({"class": part["class"].to_numpy(), "members": [value[x:y].view(np.int64) for x, y in zip(begins[:-1], begins[1:], strict=True)]})
            yield out[_classes(value, begins) == out["class"].to_numpy()]


def _folded(sketch: bytes, size: int) -> np.ndarray:
    x = np.frombuffer(sketch, np.uint8)
    return np.bitwise_xor.reduce(x.reshape(-1, size), axis=0)


def _within(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Pairs whose sketches differ in no more bits than similar sets may; a larger sketch is folded to the smaller."""
    for batch in batches:
        differ = []
        for x, y in zip(batch["sa"], batch["sb"], strict=True):
            size = min(len(x), len(y))
            differ.append(int(np.bitwise_count(_folded(x, size) ^ _folded(y, size)).sum()))
        yield batch[7 * np.array(differ, np.int64) <= batch["na"] + batch["nb"]].drop(columns=["sa", "sb"])


def _verified(texts: DataFrame, classes: DataFrame, pairs: DataFrame, scratch: Scratch) -> DataFrame:
    """Links (a, b) among pairs of classes. Sketches rule most others out before any text is read. Texts move only where
    more than SENT classes are in doubt."""
    left = classes.select(F.col("class").alias("a"), F.col("n").alias("na"), F.col("sketch").alias("sa"))
    right = classes.select(F.col("class").alias("b"), F.col("n").alias("nb"), F.col("sketch").alias("sb"))
    near = scratch.keep(pairs.join(left, "a").join(right, "b").mapInPandas(tidy(_within), "a long, b long, na long, nb long"), "near")
    needed = near.select(F.explode(F.array("a", "b")).alias("class")).distinct().join(classes.select("class", F.col("rep.ta").alias("wa"), F.col("rep.tb").alias("wb")), "class")
    needed = scratch.keep(needed, "needed")
    wanted = F.broadcast(needed) if needed.count() <= SENT else needed
    sets = texts.join(wanted, (texts["ta"] == needed["wa"]) & (texts["tb"] == needed["wb"])).select("class", "text").mapInPandas(tidy(_sets), "class long, members array<long>")
    sets = scratch.keep(sets.dropDuplicates(["class"]), "sets")
    both = near.join(sets.select(F.col("class").alias("a"), F.col("members").alias("sa")), "a").join(sets.select(F.col("class").alias("b"), F.col("members").alias("sb")), "b")
    common = F.size(F.array_intersect("sa", "sb"))
    links = scratch.keep(both.filter(100 * common >= PERCENT * (F.col("na") + F.col("nb") - common)).select("a", "b"), "links")
    scratch.drop(near, needed, sets)
    return links


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_groups(table(spark, sf_dir, "documents"))
