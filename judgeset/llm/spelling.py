"""Spelling variants: words walk through tries of all words with at most one edit, level by level, as a chain of joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from judgeset.llm._tables import Scratch, table

#: Longest word (code points) that walks the trie; see near_words for longer ones.
DEEPEST = 40
#: Levels of the trie that one job walks before its states are written.
STRIDE = 4
#: Down to this depth the tries have at most 2 (1 + 90 + 90^2) nodes, as a word's letters are 90 different ones: broadcast.
SHALLOW = 2

RUN = "[A-Za-z\\u00C0-\\u00FF]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def count_words(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least: int = 3, shortest: int = 5, every: int = 97) -> DataFrame:
    """(word, n): runs of Latin letters, A to Z in lower case, with at least shortest code points and least occurrences.

    One run in every, chosen by the crc32 of "doc_id:run", first loses the code point at crc32 mod length. A null text has
    no runs; a null doc_id counts as the empty string. Counts are summed up before the shuffle.
    """
    runs = F.regexp_extract_all(F.translate(F.col(text), _UPPER, _LOWER), F.lit(RUN), F.lit(0))
    ids = F.concat(F.coalesce(F.col(doc_id).cast("string"), F.lit("")), F.lit(":"))
    each = docs.select(ids.alias("of"), F.explode(runs).alias("run")).filter(F.char_length("run") >= shortest)
    h = F.crc32(F.concat("of", "run").cast("binary"))
    k = (F.col("h") % F.char_length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), k), F.substring("run", k + 2, F.char_length("run")))
    words = each.withColumn("h", h).select(F.when(F.col("h") % every == 0, cut).otherwise(F.col("run")).alias("word"))
    return words.filter(F.char_length("word") >= shortest).groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least)


#: The letters of words, in code-point order.
LETTERS = [chr(c) for c in (*range(97, 123), *range(0xC0, 0x100))]
#: First character of the nodes of the two tries, of the words as they are and read from the end.
AHEAD, BACK = ">", "<"


def _both(words: DataFrame) -> DataFrame:
    """(way, word, start): every word as it is and from its end, and how many code points it walks unedited at first."""
    half = F.floor(F.char_length("word") / 2).cast("int")
    ways = F.array(F.struct(F.lit(AHEAD).alias("way"), F.col("word").alias("word"), half.alias("start")), F.struct(F.lit(BACK).alias("way"), F.reverse("word").alias("word"), (F.char_length("word") - half).alias("start")))
    return words.select(F.explode(ways).alias("x")).select("x.*")


def trie(walked: DataFrame) -> DataFrame:
    """(node, depth, kids, ends): every prefix of the words from two letters on, the letters that follow it, as one string
    in order, and whether it is a word. Letters are gathered as bits, so prefixes are summed up before the shuffle."""
    prefixes = F.transform(F.sequence(F.lit(2), F.char_length("word")), lambda i: F.struct(F.concat("way", F.substring("word", F.lit(1), i)).alias("node"), i.alias("depth"), F.ascii(F.substring("word", i + 1, F.lit(1))).alias("kid")))
    steps = walked.select(F.explode(prefixes).alias("x")).select("x.*")
    one, kid = F.lit(1).cast("bigint"), F.col("kid")
    low = F.when(kid.between(97, 122), F.call_function("shiftleft", one, kid - 97)).otherwise(0)
    high = F.when(kid >= 0xC0, F.call_function("shiftleft", one, kid - 0xC0)).otherwise(0)
    seen = steps.groupBy("node", "depth").agg(F.bit_or(low).alias("low"), F.bit_or(high).alias("high"), F.max(kid == 0).alias("ends"))
    set_ = lambda bits, n: F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.when(F.call_function("shiftrightunsigned", F.col(bits), i).bitwiseAND(F.lit(1).cast("bigint")) == 1, i).otherwise(-1))
    letters = lambda bits, n, first: F.transform(F.filter(set_(bits, n), lambda i: i >= 0), lambda i: F.char(i + first))
    kids = F.concat(F.when(F.col("low") != 0, F.array_join(letters("low", 26, 97), "")).otherwise(""), F.when(F.col("high") != 0, F.array_join(letters("high", 64, 0xC0), "")).otherwise(""))
    return seen.select("node", "depth", kids.alias("kids"), "ends")


def _walk(states: DataFrame, nodes: DataFrame) -> DataFrame:
    """States (word, pos, node, edits, done) one level deeper; those that have ended are passed on.

    A state without an edit goes on by its own letter, by any larger letter in its place (one edit), or first leaves out
    its own letter (one edit), which is done for the first of equal letters only (of the word as it is). So every pair of
    near words is found once: from the longer word, or from the smaller of two of one length.
    """
    at = states.join(nodes, "node", "left")
    size, pos, node = F.char_length("word"), F.col("pos"), F.col("node")
    letter = lambda i: F.substring("word", i + 1, F.lit(1))
    step = lambda at_pos, to, edits, done=False: F.struct(at_pos.cast("int").alias("pos"), to.alias("node"), F.lit(edits).alias("edits"), F.lit(done).alias("done"))
    none = F.array().cast("array<struct<pos:int,node:string,edits:int,done:boolean>>")

    def follow(at_pos: Column, edits: int) -> Column:
        """By the own letter at at_pos, or to the end where the word has no more."""
        own = letter(at_pos)
        if edits == 0:
            return F.when((at_pos < size) & F.contains("kids", own), F.array(step(at_pos + 1, F.concat(node, own), 0))).otherwise(none)
        return F.when(at_pos == size, F.when(F.col("ends"), F.array(step(at_pos, node, 1, True))).otherwise(none)).when(F.contains("kids", own), F.array(step(at_pos + 1, F.concat(node, own), 1))).otherwise(none)

    others = F.transform(F.filter(F.split("kids", ""), lambda kid: kid > letter(pos)), lambda kid: step(pos + 1, F.concat(node, kid), 1))
    ahead = F.substring(node, F.lit(1), F.lit(1)) == AHEAD
    first = F.when(ahead, letter(pos) != letter(pos - 1)).otherwise((pos == size - 1) | (letter(pos) != letter(pos + 1)))
    unedited = F.concat(follow(pos, 0), others, F.when(first, follow(pos + 1, 1)).otherwise(none))
    moves = F.when(F.col("done"), F.array(F.struct("pos", "node", "edits", "done"))).when(F.col("kids").isNull(), none)
    moves = moves.when(F.col("edits") == 1, follow(pos, 1)).when(pos < size, unedited).otherwise(none)
    return at.select("word", F.explode(moves).alias("x")).select("word", "x.*")


def near_words(words: DataFrame, scratch: Scratch) -> DataFrame:
    """(a, b): every pair of distinct words that one inserted, deleted or replaced code point turns into each other, once.

    Words of up to DEEPEST code points walk a trie: states (word, pos, node, edits) are joined with the trie's nodes of one
    level after the other. Near the root a trie has every letter at every node, so edits there would multiply states that
    soon die. Therefore a word walks twice: as it is, with the edit in its second half, and from its end through a trie of
    the words read backwards, with the edit in what is its first half. Either walk begins at the node of its unedited half.
    What many words share is split by Spark's skew join; each node has one row. Longer words would need a join a code
    point, so pairs of them are found by the words with one code point left out, as 64-bit hashes that are checked.
    """
    walked = scratch.keep(_both(words.filter(F.char_length("word") <= DEEPEST).select("word")), "walked")
    levels = scratch.split(trie(walked).repartition("depth", F.pmod(F.xxhash64("node"), F.lit(16))), "trie", "depth", DEEPEST + 1)
    starts = walked.select("word", F.col("start").alias("pos"), F.concat("way", F.substring("word", F.lit(1), F.col("start"))).alias("node"), F.lit(0).alias("edits"), F.lit(False).alias("done"))
    deepest = walked.agg(F.max(F.char_length("word"))).first()[0] or 0
    states, found = None, []
    for low in range(2, deepest + 1, STRIDE):
        for depth in range(low, min(low + STRIDE, deepest + 1)):
            new = starts.filter(F.col("pos") == depth)
            nodes = F.broadcast(levels[depth]) if depth <= SHALLOW else levels[depth]
            states = _walk(new if states is None else states.unionByName(new), nodes)
        kept = scratch.keep(states, f"level-{low}")
        back = F.substring("node", F.lit(1), F.lit(1)) == BACK
        plain = lambda c, back=back: F.when(back, F.reverse(c)).otherwise(c)
        found.append(kept.filter("done").select(plain(F.col("word")).alias("a"), plain(F.substring("node", F.lit(2), F.char_length("node"))).alias("b")))
        states = kept.filter("NOT done")
    out = _long_pairs(words, scratch)
    for pairs in found:
        out = out.unionByName(pairs)
    return out


def _long_pairs(words: DataFrame, scratch: Scratch) -> DataFrame:
    """Near pairs of which one word has more than DEEPEST code points; a variant is a word without its pos-th code point.

    Words with one variant at one place differ in that place only, so all pairs of such a group are near, and it has no
    more members than there are letters; a variant equal to a word is a pair too.
    """
    long = words.filter(F.char_length("word") >= DEEPEST).select("word")
    without = lambda word, pos: F.concat(F.substring(word, F.lit(1), pos), F.substring(word, pos + 2, F.char_length(word)))
    variants = long.select("word", F.posexplode(F.transform(F.sequence(F.lit(0), F.char_length("word") - 1), lambda i: F.xxhash64(without(F.col("word"), i)))).alias("pos", "key"))
    variants = scratch.keep(variants, "variants")
    other = variants.select(F.col("word").alias("b"), "pos", "key")
    replaced = variants.select(F.col("word").alias("a"), "pos", "key").join(other, ["key", "pos"]).filter("a < b").filter(without(F.col("a"), F.col("pos")) == without(F.col("b"), F.col("pos")))
    first = variants.filter((F.col("pos") == 0) | (F.substring("word", F.col("pos") + 1, F.lit(1)) != F.substring("word", F.col("pos"), F.lit(1))))
    whole = long.select(F.col("word").alias("b"), F.xxhash64("word").alias("key"))
    deleted = first.select(F.col("word").alias("a"), "pos", "key").join(whole, "key").filter(without(F.col("a"), F.col("pos")) == F.col("b"))
    pairs = replaced.select("a", "b").unionByName(deleted.select("a", "b"))
    return pairs.filter(F.greatest(F.char_length("a"), F.char_length("b")) > DEEPEST)


def _roots(forms: DataFrame, scratch: Scratch) -> DataFrame:
    """(word, root) of the words that have a form: each round doubles the steps that a pointer takes."""
    now = scratch.keep(forms.select("word", F.col("form").alias("root")), "pointers")
    while True:
        onward = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        after = scratch.keep(now.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "pointers")
        scratch.drop(now)
        now = after.drop("moved")
        now._scratch_path = after._scratch_path
        if after.filter("moved").isEmpty():
            return now


def spelling_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(word, form, root, n, n_near, form_n): every word with the more frequent spelling it is a variant of.

    Words and n as in count_words. n_near counts the words at one inserted, deleted or replaced code point. form is that
    of them with the largest n (ties: the smallest in code-point order) if its n is at least twice the word's, else null;
    root follows forms to the last, and is the word itself without a form. Null and empty texts have no words, repeated
    rows count each time, only the two columns are read, and an empty table gives no rows.
    """
    scratch = Scratch(docs.sparkSession, "spelling")
    words = scratch.keep(count_words(docs, doc_id, text), "words")
    pairs = scratch.keep(near_words(words, scratch), "pairs")
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    # the largest n, then the smallest word: two aggregates over what a word has, a few hundred at most
    sized = both.join(words.select(F.col("word").alias("b"), "n"), "b")
    most = sized.groupBy("a").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("n")).alias("m"), "b")).alias("top"))
    near = most.select(F.col("a").alias("word"), "n_near", F.col("top.b").alias("best"), (-F.col("top.m")).alias("best_n"))
    joined = words.join(near, "word", "left").withColumn("is_form", F.coalesce(F.col("best_n") >= 2 * F.col("n"), F.lit(False)))
    out = joined.select("word", F.when(F.col("is_form"), F.col("best")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(F.col("is_form"), F.col("best_n")).alias("form_n"))
    out = scratch.keep(out, "forms")
    roots = _roots(out.filter("form IS NOT NULL"), scratch)
    return out.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of documents with their more frequent spellings."""
    return spelling_groups(table(spark, sf_dir, "documents"))
