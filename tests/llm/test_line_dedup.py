from collections import Counter

from judgeset.llm.line_dedup import drop_boilerplate_lines


def brute_force(rows, ratio=0.1, least=2):
    pages, on = Counter(), Counter()
    for _, host, text in rows:
        if host is not None:
            pages[host] += 1
            on.update({(host, x.strip(" \t\n\x0b\x0c\r")) for x in (text or "").split("\n")} - {(host, "")})
    bad = {k for k, n in on.items() if n >= least and n > ratio * pages[k[0]]}
    out = []
    for i, host, text in rows:
        if text is None:
            out.append((i, None, 0, 0))
            continue
        lines = text.split("\n")
        left = [x for x in lines if (host, x.strip(" \t\n\x0b\x0c\r")) not in bad]
        out.append((i, "\n".join(left), len(lines), len(lines) - len(left)))
    return sorted(out, key=str)


def got(df):
    return sorted(((r["page_id"], r["text"], r["n_lines"], r["n_dropped"]) for r in df.collect()), key=str)


def test_pages_query(against_oracle):
    against_oracle("op2_line_dedup", "/root/testdata/sf0.01")


def test_documents_by_source(spark):
    rows = [(r["doc_id"], r["source"], r["text"]) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    rows = [(i, None if i % 17 == 0 else "s" if i % 3 else "t", f"Menu\n{t}\n  All rights reserved  " if i % 4 else t) for i, _, t in rows]
    df = spark.createDataFrame(rows, "page_id long, host string, text string").repartition(5)
    assert got(drop_boilerplate_lines(df)) == brute_force(rows)


def test_odd_rows(spark):
    rows = [(1, "h", None), (2, "h", ""), (3, None, "x\nx"), (None, "h", "x")] + [(9, "h", "x\n\n y ")] * 6
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "page_id long, host string, text string, n_lines int, site int")
    assert got(drop_boilerplate_lines(df)) == brute_force(rows)
    assert drop_boilerplate_lines(df.limit(0)).count() == 0


def test_small_hosts_and_clashing_names(spark):
    """The ratio alone decides from two pages on; the operator's own columns give way to any of the table's."""
    rows = [(1, "one", "a\nb\na"), (2, "two", "a\nb"), (3, "two", "a\nc"), (4, "two", "d")]
    names = ["site", "_site", "boiler", "left", "Left", "__boiler", "keys", "on"]
    df = spark.createDataFrame([(*r, *range(8)) for r in rows], "page_id long, host string, text string, " + ", ".join(f"`x{i}` int" for i in range(8)))
    df = df.toDF("page_id", "host", "text", *[n if n != "Left" else "LEFT_" for n in names])
    out = drop_boilerplate_lines(df)
    assert got(out) == brute_force(rows) == sorted([(1, "a\nb\na", 3, 0), (2, "b", 2, 1), (3, "c", 2, 1), (4, "d", 1, 0)], key=str)
    assert out.columns == [*df.columns, "n_lines", "n_dropped"] and [r["__boiler"] for r in out.collect()] == [5] * 4
