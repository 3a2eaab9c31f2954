import corpus_pipeline as P


def test_stages_keep_their_promises(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    rows = {r["doc_id"]: r for r in docs.collect()}
    kept = P.remove_toxic(spark, docs, small)
    assert kept.columns == P.COLUMNS
    ids = {r["doc_id"] for r in kept.collect()}
    toxic = {r["doc_id"] for r in spark.read.parquet(f"{small}/labels.parquet").filter("toxic = 0").collect()}
    assert len(toxic & set(rows) - ids) <= 0.1 * len(toxic) + 1
    lines = P.remove_boilerplate(spark, docs, small)
    for r in lines.collect():
        assert set(r["text"].split("\n")) <= set(rows[r["doc_id"]]["text"].split("\n")) | {""}
        assert r["n_chars"] == len(r["text"])
    assert lines.count() == len(rows)
    single = P.remove_near_duplicates(spark, docs, small)
    from judgeset.llm.jaccard_join import near_duplicate_groups

    groups = {r["component_id"] for r in near_duplicate_groups(docs).collect()}
    assert sorted(r["doc_id"] for r in single.collect()) == sorted(groups)
    mixed = [r["doc_id"] for r in P.mix(spark, docs, small).collect()]
    assert set(mixed) == set(rows) and len(mixed) >= len(rows)
    pieces = P.pack(spark, docs, small).collect()
    assert {r["doc_id"] for r in pieces} == set(rows)


def test_a_line_on_a_tenth_of_a_source_goes(spark):
    def text(i, of):
        planted = ["Subscribe to our newsletter"] * (i % 10 == 0) + ["A rarer line"] * (i % 25 == 0)
        return "\n".join([f"opening {of} {i}", *planted, f"ending {of} {i}"])

    rows = [(1000 * of + i, text(i, of), "en", f"s{of}", len(text(i, of))) for of in range(2) for i in range(200)]
    rows += [(2000 + i, "Subscribe to our newsletter" if i % 50 == 0 else f"other {i}", "en", "elsewhere", 9) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(5)
    got = {r["doc_id"]: r["text"] for r in P.remove_boilerplate(spark, docs, "").collect()}
    assert got == {i: t if s == "elsewhere" else "\n".join(x for x in t.split("\n") if not x.startswith("Subscribe")) for i, t, _, s, _ in rows}


def test_one_row_of_each_group_stays(spark):
    def words(name, start=0, stop=60):
        return " ".join(f"{name}{k}" for k in range(start, stop))

    chain = [words("c", 0, 60), words("c", 6, 66), words("c", 12, 72)]  # neighbours link, the ends do not
    rows = [
        *[(None, words("n")), (None, words("n")), (None, words("n") + " more")],  # near and exact copies without id
        *[(5, words("r"))] * 3,  # a repeated row
        (7, words("x")), (7, words("y")), (3, words("x") + " more"),  # one id for a copy and for a clean text
        (20, chain[0]), (None, chain[1]), (22, chain[2]),  # ends that link only through a document without id
        *[(None, None), (None, ""), (30, "")],
    ]
    docs = spark.createDataFrame([(i, t, "en", f"s{k % 3}", k) for k, (i, t) in enumerate(rows)], "doc_id long, text string, lang string, source string, n_chars long").repartition(4)
    single = P.remove_near_duplicates(spark, docs, "")
    assert single.columns == P.COLUMNS
    got = [(r["doc_id"], r["text"]) for r in single.collect()]
    unnamed = [t for i, t in got if i is None and t]
    assert len(unnamed) == 1 and unnamed[0].startswith(words("n"))
    want = [(5, words("r")), (7, words("y")), (3, words("x") + " more"), (20, chain[0]), (None, None), (None, ""), (30, "")]
    assert sorted((g for g in got if g != (None, unnamed[0])), key=str) == sorted(want, key=str)


def test_whole_run(spark, small):
    """The five stages in plain Python, on the same weights and token counts, give the same pieces."""
    import math
    import zlib
    from collections import Counter

    from judgeset.llm import toxicity
    from judgeset.llm.packing import _tokenizer, default_tokenizer

    from . import test_classifiers, test_jaccard_join

    assert [name for name, _ in P.STAGES] == ["toxicity", "line_dedup", "jaccard_join", "mixing", "packing"]
    table = spark.read.parquet(f"{small}/documents.parquet")
    docs = [(r["doc_id"], r["text"], r["source"]) for r in table.collect()]
    w = toxicity.fit(table, spark.read.parquet(f"{small}/labels.parquet")).astype("float32")

    def toxic(text):
        clean = 1.0
        for _, _, words in toxicity.sentences(text):
            clean *= 1 - 1 / (1 + math.exp(-(float(w[-1]) + sum(float(w[test_classifiers._crc(x)]) for x in set(words)))))
        return 1 - clean >= 0.5

    docs = [d for d in docs if not toxic(d[1])]
    of_source, on = Counter(s for *_, s in docs), Counter()
    blank = " \t\n\x0b\x0c\r"
    for _, text, s in docs:
        on.update({(s, x.strip(blank)) for x in text.split("\n")} - {(s, "")})
    boiler = {k for k, n in on.items() if n >= P.LINE_DOCUMENTS and n > P.LINE_RATIO * of_source[k[0]]}
    docs = [(i, "\n".join(x for x in text.split("\n") if (s, x.strip(blank)) not in boiler), s) for i, text, s in docs]
    groups = test_jaccard_join.brute_force([(i, t) for i, t, _ in docs])
    docs = [d for d in docs if groups[d[0]][1] == d[0]]

    mixed = Counter(r["doc_id"] for r in P.mix(spark, spark.createDataFrame([(i, t, "en", s, len(t)) for i, t, s in docs], table.schema), small).collect())
    tokens = Counter()
    for _, t, s in docs:
        tokens[s] += len(t.split())
    most = max(tokens.values())
    limit = lambda alpha: max((most / n) ** (1 - alpha) for n in tokens.values())
    alpha = next((a / 10_000 for a in range(10_001) if limit(a / 10_000) <= P.MAX_REPEATS + 1e-9), 1.0)
    for s, n in tokens.items():  # every source comes within one document of its weight
        want, longest = most ** (1 - alpha) * n**alpha, max(len(t.split()) for _, t, x in docs if x == s)
        got = sum(mixed[i] * len(t.split()) for i, t, x in docs if x == s)
        assert want - longest - 1 <= got <= want + 1e-6 * want

    ids = {i: [*_tokenizer(default_tokenizer()).encode(t, add_special_tokens=False).ids, 1] for i, t, _ in docs}
    want = Counter()
    for i, n in mixed.items():
        for k in range(0, len(ids[i]), 4096):
            part = ids[i][k : k + 4096]
            want[i, k // 4096, k, len(part), zlib.crc32(b"".join(x.to_bytes(4, "little") for x in part))] += n
    out = P.run(spark, small).collect()
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in out) == want
    ends = {}
    for r in sorted(out, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == ends.get(r["sequence_id"], 0)
        ends[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(ends.values()) <= 4096 and len(ends) <= -(-sum(ends.values()) // 4096) + 2


def test_stages_on_odd_rows(spark, small):
    """Nulls in every column, empty and long texts, repeated rows, an empty table: each stage keeps its promises."""
    rows = [(1, None, None, None, None), (None, "", None, "s", 0), (3, "a b c d e f " * 20_000, "en", None, 5), (4, "x y", "en", "s", 3), (4, "x y", "en", "s", 3), (None, None, "en", "s", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for name, stage in P.STAGES:
        out = stage(spark, docs, small)
        ids = [r["doc_id"] for r in out.collect()]
        assert set(ids) == {1, None, 3, 4}, name
        assert len(ids) >= (5 if name == "jaccard_join" else 6), name
        if name != "packing":
            assert out.columns == P.COLUMNS
        assert stage(spark, docs.limit(0), small).count() == 0, name
    clashing = docs.selectExpr("*", "1 as score", "2 as __k", "3 as site", "4 as boiler", "5 as n_dropped", "6 as tokens", "7 as copies", "8 as ta", "9 as `class`", "10 as length")
    for name, stage in P.STAGES:
        assert {r["doc_id"] for r in stage(spark, clashing, small).collect()} == {1, None, 3, 4}, name
