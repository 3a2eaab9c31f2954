"""Removal of byte strings that occur more than once in a corpus, by prefix-free parsing.

A rolling hash runs over every text; the smallest hash inside each string of LENGTH bytes is its trigger. Triggers cut
a text into phrases: the phrase of a trigger holds the strings that have it, so neighbouring phrases overlap by
LENGTH - 1 bytes, each string lies in exactly one phrase, and equal strings lie in phrases with the same trigger and
the same place relative to it. As only strings of LENGTH bytes have to be told apart, the dictionary of phrases with
their frequencies decides everything, and the suffix array of the parse is not needed: a phrase that occurs twice is
removed whole; a phrase whose trigger no other phrase has is left alone; of the phrases between, the dictionary's
suffixes, cut to LENGTH, are sorted, and equal neighbours are removed.

Hot places: a phrase that repeats on the spot (periodic text) is one row with a count; occurrences of one trigger are
read as a stream; the suffixes of a trigger that more than MANY different phrases have are dealt out one by one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from judgeset.llm._hashing import mix, prefix_sums, span_hashes
from judgeset.llm._tables import Scratch, table, tidy

LENGTH, GRAM = 200, 64
#: Bytes that are parsed at once; longer texts are parsed in parts whose strings together are the text's.
PART = 1 << 20
#: Different phrases of one trigger whose suffixes are sorted together, and suffixes sorted at once.
MANY, SORTED = 1024, 50_000
_PLACES = np.uint64((1 << 24) - 1)
#: A row stands for n occurrences of one phrase with the strings from lo to hi of text h, of which the first occurrence
#: has the strings from lo on (strings of them).
OCCURRENCES = "trigger long, phrase long, h long, size int, lo int, hi int, strings int, n int"
#: Kinds of phrases asked about: remove whole; look at its strings; both (it stands for its copies).
WHOLE, STRINGS, BOTH = 0, 1, 2


def _encoded(texts) -> list[bytes]:
    return [t.encode("utf-8", "surrogatepass") if isinstance(t, str) else b"" for t in texts]


def _parts(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, list[bytes]]]:
    """(text number, offset in it, bytes) of parts that hold PART bytes or little more; strings never cross texts."""
    who, offset, held, size = [], [], [], 0
    for i, t in enumerate(texts):
        for at in range(0, max(1, len(t) - LENGTH + 1), PART):
            if len(t) < LENGTH:
                continue
            piece = t[at : at + PART + LENGTH - 1]
            who.append(i), offset.append(at), held.append(piece)
            size += len(piece)
            if size >= PART:
                yield np.array(who), np.array(offset), held
                who, offset, held, size = [], [], [], 0
    if held:
        yield np.array(who), np.array(offset), held


def phrases(pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of all phrases: piece, first and last string's place in it, hash of the trigger, hash of the phrase."""
    data = np.frombuffer(b"".join(pieces), np.uint8)
    sizes = np.array([len(p) for p in pieces])
    begins = np.cumsum(sizes) - sizes
    sums = prefix_sums(data)
    at = np.arange(len(data) - GRAM + 1)
    x = (span_hashes(sums, at, at + GRAM) & ~_PLACES) | (_PLACES - at.astype(np.uint64))  # of equal hashes the last counts
    width = 1
    while 2 * width <= LENGTH - GRAM + 1:
        x = np.minimum(x[:-width], x[width:])
        width *= 2
    rest = LENGTH - GRAM + 1 - width
    if rest:
        x = np.minimum(x[:-rest], x[rest:])
    place = (_PLACES - (x & _PLACES)).astype(np.int64)
    strings = sizes - LENGTH + 1
    piece = np.repeat(np.arange(len(pieces)), strings)
    start = np.repeat(begins - (np.cumsum(strings) - strings), strings) + np.arange(len(piece))
    trigger = place[start]
    new = np.ones(len(piece), bool)
    new[1:] = (trigger[1:] != trigger[:-1]) | (piece[1:] != piece[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(piece)) - 1
    lo, hi, of = start[first], start[last], piece[first]
    g = trigger[first]
    return of, lo - begins[of], hi - begins[of], span_hashes(sums, g, g + GRAM).view(np.int64), span_hashes(sums, lo, hi + LENGTH).view(np.int64)


def _parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        once = batch.groupby("h", as_index=False).agg(text=("text", "first"), size=("size", "first"), n=("size", "size"))
        h, size, copies = once["h"].to_numpy(), once["size"].to_numpy(), once["n"].to_numpy()
        for who, offset, pieces in _parts(_encoded(once["text"])):
            of, lo, hi, trigger, phrase = phrases(pieces)
            new = np.ones(len(of), bool)  # a phrase that follows itself is counted, not repeated
            new[1:] = (of[1:] != of[:-1]) | (trigger[1:] != trigger[:-1]) | (phrase[1:] != phrase[:-1])
            first = np.flatnonzero(new)
            last = np.append(first[1:], len(of)) - 1
            text, of = who[of[first]], of[first]
            yield pd.DataFrame({
                "trigger": trigger[first], "phrase": phrase[first], "h": h[text], "size": size[text], "lo": (lo[first] + offset[of]).astype(np.int32),
                "hi": (hi[last] + offset[of]).astype(np.int32), "strings": (hi[first] - lo[first] + 1).astype(np.int32), "n": (copies[text] * (last - first + 1)).astype(np.int32),
            })


ASKED = "trigger long, h long, size int, lo int, hi int, strings int, kind int"


def _asked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """From occurrences sorted by trigger, phrase and place: those of triggers that occur more than once, with kinds.

    Between batches it holds one row, the first occurrence of the phrase in work, with its count so far and whether its
    trigger has other phrases.
    """
    held: pd.DataFrame | None = None

    def judged(x: pd.DataFrame, open_: bool) -> tuple[pd.DataFrame, pd.DataFrame | None]:
        trigger, phrase, n = x["trigger"].to_numpy(), x["phrase"].to_numpy(), x["n"].to_numpy(np.int64)
        new_trigger = np.append(True, trigger[1:] != trigger[:-1])
        first = np.flatnonzero(new_trigger | np.append(True, phrase[1:] != phrase[:-1]))
        times = np.add.reduceat(n, first)
        run = np.cumsum(new_trigger)[first] - 1  # trigger of each phrase
        mixed = (np.bincount(run) > 1)[run] | (np.bincount(run, x["mixed"].to_numpy()[first]) > 0)[run]
        kind = np.zeros(len(x), np.int32)
        kind[first] = np.where(times > 1, np.where(mixed, BOTH, WHOLE), np.where(mixed, STRINGS, -1))
        place = x[["h", "size", "lo", "hi"]].to_numpy()
        again = np.zeros(len(x), bool)  # the same place once more, from another copy of the text
        again[1:] = (place[1:] == place[:-1]).all(axis=1)
        again[first] = False
        out = x.drop(columns=["phrase", "n", "mixed"]).assign(kind=kind)
        keep = (kind >= 0) & ~again
        left = None
        if open_:
            left = x.iloc[first[-1] : first[-1] + 1].assign(n=times[-1], mixed=mixed[-1])
            keep[first[-1]] = False
        return out[keep], left

    for batch in batches:
        batch = batch.assign(mixed=False)
        x = batch if held is None else pd.concat([held, batch], ignore_index=True)
        if len(x):
            out, held = judged(x, True)
            yield out
    if held is not None:
        yield judged(held, False)[0]


CONTENTS = "trigger long, h long, size int, lo int, known boolean, content binary"


def _contents(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The bytes of every phrase whose strings were asked for."""
    for batch in batches:
        rows = []
        for h, size, text, asked in zip(batch["h"], batch["size"], _encoded(batch["text"]), batch["asked"], strict=True):
            rows += [(r["trigger"], h, size, r["lo"], r["kind"] == BOTH, text[r["lo"] : r["lo"] + r["strings"] - 1 + LENGTH]) for r in asked]
            if len(rows) > 5_000:
                yield pd.DataFrame(rows, columns=["trigger", "h", "size", "lo", "known", "content"])
                rows = []
        if rows:
            yield pd.DataFrame(rows, columns=["trigger", "h", "size", "lo", "known", "content"])


RANGES = "h long, size int, lo int, hi int"


def _starts(x: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All contents in one array, where each string of LENGTH bytes starts in it, and its row."""
    sizes = x["content"].map(len).to_numpy()
    n = sizes - LENGTH + 1
    of = np.repeat(np.arange(len(x)), n)
    start = np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(np.cumsum(sizes) - sizes, n)
    return np.frombuffer(b"".join(x["content"]), np.uint8), start, of


def _sorted_suffixes(x: pd.DataFrame) -> pd.DataFrame:
    """Ranges of strings that have an equal one, from the sorted suffixes (cut to LENGTH) of the phrases in x."""
    data, start, of = _starts(x)
    cut = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(data, LENGTH)[start]).view(f"S{LENGTH}").ravel()
    order = np.argsort(cut, kind="stable")
    cut = cut[order]
    same = cut[1:] == cut[:-1]
    hit = np.zeros(len(order), bool)
    hit[order] = np.append(same, False) | np.append(False, same)
    hit &= ~x["known"].to_numpy()[of]
    place = start - (np.cumsum(n := x["content"].map(len).to_numpy()) - n)[of] + x["lo"].to_numpy()[of]
    edge = np.flatnonzero(hit & ~np.append(False, hit[:-1] & (of[1:] == of[:-1])))
    end = np.flatnonzero(hit & ~np.append(hit[1:] & (of[1:] == of[:-1]), False))
    return pd.DataFrame({"h": x["h"].to_numpy()[of[edge]], "size": x["size"].to_numpy()[of[edge]], "lo": place[edge].astype(np.int32), "hi": place[end].astype(np.int32)})


def _compared(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """From phrases sorted by trigger, MANY a trigger at most: whole triggers are sorted together, some at a time."""
    held: list[pd.DataFrame] = []
    for batch in batches:
        trigger = batch["trigger"].to_numpy()
        strings = np.cumsum(batch["content"].map(len).to_numpy() - LENGTH + 1)
        done, at = 0, sum(int((x["content"].map(len) - LENGTH + 1).sum()) for x in held)
        for e in np.flatnonzero(np.append(trigger[1:] != trigger[:-1], False)) + 1:
            if at + strings[e - 1] - (strings[done - 1] if done else 0) >= SORTED:
                yield _sorted_suffixes(pd.concat([*held, batch.iloc[done:e]], ignore_index=True))
                held, done, at = [], e, 0
        held.append(batch.iloc[done:])
        whole = pd.concat(held, ignore_index=True)
        last = whole["trigger"].to_numpy()
        split = int(np.flatnonzero(np.append(True, last[1:] != last[:-1]))[-1]) if len(last) else 0
        if len(whole) - split > MANY:
            raise ValueError("a trigger has more phrases than were counted")
        held = [whole]
    if held and len(held[0]):
        yield _sorted_suffixes(held[0])


def _strings(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Hash of every string of the phrases."""
    for batch in batches:
        for at in range(0, len(batch), 1_000):
            x = batch.iloc[at : at + 1_000]
            data, start, of = _starts(x)
            w = mix(span_hashes(prefix_sums(data), start, start + LENGTH) + mix(x["trigger"].to_numpy().view(np.uint64))[of])
            begin = (np.cumsum(n := x["content"].map(len).to_numpy()) - n)[of]
            yield pd.DataFrame({"w": w.view(np.int64), "h": x["h"].to_numpy()[of], "size": x["size"].to_numpy()[of], "p": (start - begin + x["lo"].to_numpy()[of]).astype(np.int32), "known": x["known"].to_numpy()[of]})


def _repeated(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """From strings in hash order: places of those that have an equal neighbour. Holds one row between batches."""
    held, told = None, False
    for batch in batches:
        if held is not None:
            batch = pd.concat([held, batch], ignore_index=True)
        if not len(batch):
            continue
        w = batch["w"].to_numpy()
        same = np.zeros(len(w), bool)
        same[1:] = w[1:] == w[:-1]
        hit = same | np.append(same[1:], False)
        out = batch[hit & ~batch["known"].to_numpy()]
        if held is not None and len(out) and hit[0] and told:  # the held row has gone out already
            out = out[1:] if not batch["known"].iloc[0] else out
        told = bool(hit[-1])
        held = batch.iloc[-1:]
        yield out[["h", "size", "p"]]


SPANS = "array<struct<start:long,length:long>>"


def _cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        spans, kept = [], []
        for text, ranges in zip(_encoded(batch["text"]), batch["ranges"], strict=True):
            gone, rest, at = [], [], 0
            for lo, hi in sorted((r["lo"], r["hi"] + LENGTH) for r in ranges):
                if gone and lo <= gone[-1][1]:
                    gone[-1][1] = max(gone[-1][1], hi)
                else:
                    gone.append([lo, hi])
            for lo, hi in gone:
                rest.append(text[at:lo])
                at = hi
            spans.append([{"start": lo, "length": hi - lo} for lo, hi in gone])
            kept.append(b"".join([*rest, text[at:]]))
        yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "spans": spans, "kept": kept})


def remove_repeats(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, spans (start and length in bytes) that were removed, and kept (the other bytes), of every row.

    A byte goes if it lies in a string of LENGTH bytes that also starts at another place of the corpus, in the same
    text or another; places are judged on the input. Null texts are empty; texts below LENGTH bytes stay whole. Rows
    with equal texts are copies of each other, whatever their ids, and null ids are kept. Texts of any length are parsed
    in parts. Other columns are not read. An empty table gives no rows. Phrases are told apart by two 64-bit hashes, of
    trigger and phrase; so are the strings of triggers with more than MANY phrases, all other strings byte by byte.
    """
    scratch = Scratch(df.sparkSession, "repeats")
    source = df.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    source = source.withColumn("h", F.xxhash64("text")).withColumn("size", F.octet_length("text"))
    order = ["trigger", "phrase", "h", "size", "lo", "hi"]
    found = source.filter(F.col("size") >= LENGTH).select("h", "size", "text").mapInPandas(tidy(_parse), OCCURRENCES)
    asked = scratch.keep(found.repartition("trigger").sortWithinPartitions(*order).mapInPandas(tidy(_asked), ASKED), "asked")

    open_ = asked.filter(F.col("kind") != WHOLE)
    requests = scratch.keep(open_.groupBy("h", "size").agg(F.collect_list(F.struct("trigger", "lo", "strings", "kind")).alias("asked")), "requests")
    wanted = requests.select("h", "size")  # a few numbers a text: Spark broadcasts them only while the table is small
    texts = source.join(wanted, ["h", "size"], "left_semi").select("h", "size", "text").dropDuplicates(["h", "size"])
    contents = scratch.keep(texts.join(requests, ["h", "size"]).mapInPandas(tidy(_contents), CONTENTS), "contents")
    crowded = scratch.keep(open_.groupBy("trigger").count().filter(F.col("count") > MANY).select("trigger"), "crowded")
    hits = contents.join(crowded, "trigger", "left_anti").repartition("trigger").sortWithinPartitions("trigger").mapInPandas(tidy(_compared), RANGES)
    strings = contents.join(crowded, "trigger", "left_semi").mapInPandas(tidy(_strings), "w long, h long, size int, p int, known boolean")
    single = strings.repartition("w").sortWithinPartitions("w").mapInPandas(tidy(_repeated), "h long, size int, p int")
    whole = asked.filter(F.col("kind") != STRINGS)
    ranges = whole.select("h", "size", "lo", "hi").unionByName(hits).unionByName(single.select("h", "size", F.col("p").alias("lo"), F.col("p").alias("hi")))
    ranges = scratch.keep(ranges.groupBy("h", "size").agg(F.collect_list(F.struct("lo", "hi")).alias("ranges")), "ranges")
    scratch.drop(asked, requests, contents, crowded)

    told = source.join(ranges, ["h", "size"], "left")
    clear = told.filter(F.col("ranges").isNull()).select("doc_id", F.array().cast(SPANS).alias("spans"), F.col("text").cast("binary").alias("kept"))
    cut = told.filter(F.col("ranges").isNotNull()).select("doc_id", "text", "ranges")
    return clear.unionByName(cut.mapInPandas(tidy(_cut), f"doc_id long, spans {SPANS}, kept binary"))


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["length"])
    done = remove_repeats(table(spark, sf_dir, "documents")).withColumn("n_removed", removed)
    return done.select("doc_id", (F.octet_length("kept") + F.col("n_removed")).alias("n_bytes"), "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
