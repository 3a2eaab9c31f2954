"""Personal data: expressions propose spans, checksums confirm them, words nearby raise or lower their scores."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from judgeset.llm._tables import fresh, table

#: Code points before and after a proposal in which context words count.
BEFORE, AFTER = 40, 24
#: Points that a context word adds or takes, and what a span that is not one of the base kinds needs.
CONTEXT, NEEDED = 40, 50

# The lengths of bank account numbers by country.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FO GL NL", 19: "MK SI", 20: "AT BA EE KZ LT LU XK", 21: "CH CR HR LI LV", 22: "BG BH DE GB GE IE ME RS", 23: "AE GI IL IQ TL",
    24: "AD CZ DZ ES MD PK RO SA SE SK TN VG", 25: "PT", 26: "IS TR", 27: "FR GR IT MC SM", 28: "AL AZ CY DO GT HU LB PL", 29: "BR EG PS QA UA", 30: "JO KW MU", 31: "MT SC",
}


@dataclass(frozen=True)
class Kind:
    """One kind of personal data. pattern takes the same matches as plain, without Java's recursion and without going
    over a long run of characters again from each of them. A proposal's text is checked by confirm, its surroundings by
    edges (patterns that the text before and after must not match). A text without a match of sign has none of the kind."""

    name: str
    plain: str
    points: int
    raises: str = ""
    lowers: str = ""
    pattern: str = ""
    confirm: Callable[[Column], Column] | None = None
    edges: tuple[str, str] | None = None
    sign: str = ""
    base: bool = False


def _let(value: Column, f: Callable[[Column], Column]) -> Column:
    """f of a value that is computed once, whatever f repeats."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes Luhn's check."""

    def total(d: Column) -> Column:
        n = F.char_length(d)
        value = F.transform(F.sequence(F.lit(0), n - 1), lambda i: (F.ascii(F.substring(d, n - i, F.lit(1))) - 48) * (1 + i % 2))
        return F.aggregate(F.transform(value, lambda v: F.when(v > 9, v - 9).otherwise(v)), F.lit(0), lambda a, v: a + v)

    return _let(digits, total) % 10 == 0


def mod97(account: Column) -> Column:
    """Whether a bank account number without blanks has the remainder 1 by 97."""

    def rest(x: Column) -> Column:
        def step(r: Column, i: Column) -> Column:
            return _let(F.ascii(F.substring(x, i, F.lit(1))), lambda c: F.when(c < 58, (r * 10 + c - 48) % 97).otherwise((r * 100 + c - 55) % 97))

        return F.aggregate(F.sequence(F.lit(1), F.char_length(x)), F.lit(0), step)

    return _let(account, lambda a: rest(F.concat(F.substring(a, 5, 64), F.substring(a, 1, 4)))) == 1


def _ip(m: Column) -> Column:
    return F.forall(F.split(m, "\\."), lambda x: x.rlike("^0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})$"))


def _card(m: Column) -> Column:
    return _let(_digits(m), lambda d: F.when(F.char_length(d).between(12, 19), luhn(d)).otherwise(F.lit(False)))


_WORD_EDGES = ("[A-Za-z0-9]\\z", "^[A-Za-z0-9]")
_DIGIT_EDGES = ("[A-Za-z0-9_.+-]\\z|[0-9+][\\x20().-]+\\z", "^[A-Za-z0-9_@]|^[\\x20.-]?[0-9]")
_IBAN = "|".join(f"(?:{'|'.join(countries.split())})[0-9]{{2}}(?:\\x20?[A-Z0-9]){{{n - 4}}}" for n, countries in IBAN_LENGTHS.items())
_CALLS = "phone|telephone|tel|call|mobile|cell|fax|whatsapp|telefon|handy|telefono"
_COUNTS = "order|invoice|isbn|serial|part|model|tracking|article"

#: In the order in which spans of one start are listed. The first four are the base kinds, whose spans always stay.
KINDS = [
    Kind("email", "[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+", 80, "mail|e-mail|email|contact|kontakt|contacto|write", "noreply|no-reply",
         pattern="[A-Za-z0-9._%+-](?:(?<=\\G.)|(?<![A-Za-z0-9._%+-]{2}))[A-Za-z0-9._%+-]*+@[A-Za-z0-9-]++(?:\\.[A-Za-z0-9-]++)++", sign="@", base=True),
    Kind("ip", "[0-9]+(\\.[0-9]+)(\\.[0-9]+)(\\.[0-9]+)", 60, "ip|ipv4|address|host|server|login|client", "version|release|section|chapter",
         pattern="[0-9](?<![0-9]{2})[0-9]*+(?:\\.[0-9]++){3}", confirm=_ip, base=True),
    Kind("card", "[0-9]([\\x20-]?[0-9])+", 80, "card|visa|mastercard|amex|credit|debit|payment|karte|kreditkarte|tarjeta|carte", _COUNTS,
         pattern="[0-9](?:[\\x20-]?[0-9])++", confirm=_card, base=True),
    Kind("phone", "\\+[0-9][\\x20().0-9-]+[0-9]", 70, _CALLS, _COUNTS, confirm=lambda m: F.char_length(_digits(m)).between(9, 15), sign="\\+", base=True),
    Kind("iban", _IBAN, 90, "iban|account|bank|konto|cuenta|compte", confirm=lambda m: mod97(F.replace(m, F.lit(" "), F.lit(""))), edges=_WORD_EDGES, sign="[A-Z]{2}[0-9]{2}"),
    Kind("ssn", "[0-9]{3}-[0-9]{2}-[0-9]{4}", 30, "ssn|social security|social security number|taxpayer|tin", _COUNTS, confirm=lambda m: ~m.rlike("^(?:000|666|9)|-00-|0000$"), edges=_DIGIT_EDGES),
    Kind("tel", "\\(?[0-9]{3}\\)?[\\x20.-][0-9]{3}[\\x20.-][0-9]{4}", 30, _CALLS, _COUNTS, edges=_DIGIT_EDGES),
    Kind("secret", "[A-Za-z0-9_-]{20,}", 20, "token|secret|password|passwd|pwd|api key|api_key|apikey|api-key|access_key|private_key", "commit|sha1|sha256|md5|checksum|hash|digest",
         pattern="[A-Za-z0-9_-](?<![A-Za-z0-9_-]{2})[A-Za-z0-9_-]{19,}+", confirm=lambda m: m.rlike("[0-9]") & m.rlike("[A-Za-z]"), edges=("[A-Za-z0-9_-]\\z", "^[A-Za-z0-9_-]")),
]
BASE = [k.name for k in KINDS if k.base]
RANK = {k.name: i for i, k in enumerate(KINDS)}

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_SPAN = "struct<start:bigint,rank:int,end:bigint,points:int>"
#: Spans are numbered in portions of so many, so that what is copied to append one stays short.
_PORTION = 256


def _words(words: str) -> str:
    return f"(?:^|[^a-z])(?:{words})(?:[^a-z]|$)"


def _points(kind: Kind, near: Column) -> Column:
    raised = F.when(near.rlike(_words(kind.raises)), CONTEXT).otherwise(0) if kind.raises else F.lit(0)
    lowered = F.when(near.rlike(_words(kind.lowers)), CONTEXT).otherwise(0) if kind.lowers else F.lit(0)
    return F.greatest(F.lit(0), F.least(F.lit(100), F.lit(kind.points) + raised - lowered))


def _proposals(text: Column, kind: Kind) -> Column:
    """(gap, len, points, ok) of each match of the kind: code points since the match before it, its own, its score, and
    whether it is a span. Context reaches no further than the matches of the kind on either side."""
    pattern, none = kind.pattern or kind.plain, F.array().cast("array<struct<gap:bigint,len:bigint,points:int,ok:boolean>>")

    def each(matches: Column, pieces: Column) -> Column:
        def one(m: Column, i: Column) -> Column:
            before, after = F.right(F.get(pieces, i), F.lit(BEFORE)), F.left(F.get(pieces, i + 1), F.lit(AFTER))
            ok = kind.confirm(m) if kind.confirm else F.lit(True)
            if kind.edges:
                ok = ok & ~before.rlike(kind.edges[0]) & ~after.rlike(kind.edges[1])
            # a base span's score changes nothing but itself; what fails its check needs none
            points = F.when(ok, _points(kind, F.translate(F.concat_ws("|", before, after), _UPPER, _LOWER))).otherwise(0)
            sizes = F.char_length(F.get(pieces, i)).cast("bigint").alias("gap"), F.char_length(m).cast("bigint").alias("len")
            scored = F.struct(*sizes, points.cast("int").alias("points"), ok.alias("ok"))
            return scored if kind.base else scored.withField("ok", ok & (points >= NEEDED))

        return F.transform(matches, one)

    def between(matches: Column) -> Column:
        return F.when(F.size(matches) > 0, _let(F.split(text, pattern, -1), lambda pieces: each(matches, pieces))).otherwise(none)

    found = _let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), between)
    return F.when(text.rlike(kind.sign), found).otherwise(none) if kind.sign else found


def _placed(proposals: Column, rank: int) -> Column:
    """Spans with their places, summed up inside portions first and over the portions then."""
    empty = lambda kind: F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast(f"array<{kind}>").alias("out"))

    def append(acc: Column, x: Column) -> Column:
        start = acc["at"] + x["gap"]
        span = F.struct(start.alias("start"), F.lit(rank).alias("rank"), (start + x["len"]).alias("end"), x["points"].alias("points"))
        return F.struct((start + x["len"]).alias("at"), F.when(x["ok"], F.concat(acc["out"], F.array(span))).otherwise(acc["out"]).alias("out"))

    def shift(acc: Column, part: Column) -> Column:
        return F.struct((acc["at"] + part["at"]).alias("at"), F.concat(acc["out"], F.array(F.struct(acc["at"].alias("at"), part["out"].alias("out")))).alias("out"))

    def all_of(z: Column) -> Column:
        parts = F.transform(F.sequence(F.lit(0), F.floor((F.size(z) - 1) / _PORTION).cast("int")), lambda c: F.aggregate(F.slice(z, c * _PORTION + 1, _PORTION), empty(_SPAN), append))
        placed = F.aggregate(parts, empty(f"struct<at:bigint,out:array<{_SPAN}>>"), shift, lambda acc: acc["out"])
        moved = lambda o: F.transform(o["out"], lambda x: F.struct((x["start"] + o["at"]).alias("start"), x["rank"].alias("rank"), (x["end"] + o["at"]).alias("end"), x["points"].alias("points")))
        return F.flatten(F.transform(placed, moved))

    return _let(proposals, lambda z: F.when(F.size(z) > 0, all_of(z)).otherwise(F.array().cast(f"array<{_SPAN}>")))


def find_pii(df: DataFrame, text: str = "text", out: str = "pii") -> DataFrame:
    """df with out: array of (start, rank, end, points), the personal data of each text, ordered by start and kind.

    Places count code points from 0, ends are exclusive; rank is the kind's place in KINDS. Each kind's expression takes
    the leftmost non-overlapping matches; a match that fails its check is dropped and not tried again otherwise. Cards
    have to pass Luhn's check and bank accounts the remainder by 97. points (0 to 100) starts from the kind's own and
    moves by 40 where a word that speaks for or against it stands within 40 code points before or 24 after. Spans of the
    base kinds (email, ip, card, phone) stay whatever their points; the other kinds need 50, so numbers that look like
    anything count only beside a word that names them. Spans of different kinds may overlap.

    A null or empty text has no spans; repeated rows are treated alike. Other columns are passed on, and one named out
    is replaced. An empty table gives no rows. Everything is one projection: no row leaves its task, and the work grows
    with a text's length and its number of matches.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    spans = F.concat(*[_placed(_proposals(whole, k), i) for i, k in enumerate(KINDS)])
    return df.withColumn(out, F.array_sort(spans))


def redact(df: DataFrame, text: str = "text", mark: str = "*") -> DataFrame:
    """df with every code point inside a span replaced by mark. A null text stays null. Each span is cut out of the whole
    text, so the work grows with a text's length times its number of spans."""
    pii, joined = fresh(df, "pii", "joined")

    def cover(acc: Column, s: Column) -> Column:
        """Overlapping spans become one: (end so far, covers)."""
        apart = s["start"] >= acc["end"]
        new = F.struct(F.when(apart, s["start"]).otherwise(acc["end"]).alias("start"), s["end"].alias("end"))
        return F.struct(F.greatest(acc["end"], s["end"]).alias("end"), F.when(s["end"] > acc["end"], F.concat(acc["out"], F.array(new))).otherwise(acc["out"]).alias("out"))

    start = F.struct(F.lit(0).cast("bigint").alias("end"), F.array().cast("array<struct<start:bigint,end:bigint>>").alias("out"))
    found = find_pii(df, text, pii).withColumn(joined, F.aggregate(pii, start, cover, lambda acc: acc["out"]))

    def rest(c: Column) -> Column:
        gaps = F.transform(joined, lambda s, i: F.concat(F.substring(c, (F.when(i > 0, F.get(F.col(joined), i - 1)["end"]).otherwise(0) + 1).cast("int"), (s["start"] - F.when(i > 0, F.get(F.col(joined), i - 1)["end"]).otherwise(0)).cast("int")), F.repeat(F.lit(mark), (s["end"] - s["start"]).cast("int"))))
        return F.concat(F.array_join(gaps, ""), F.substring(c, (F.element_at(F.col(joined), -1)["end"] + 1).cast("int"), F.char_length(c)))

    masked = F.when(F.size(joined) > 0, rest(F.col(text))).otherwise(F.col(text))
    return found.withColumn(text, masked).drop(pii, joined)


def pii_report(df: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: id, n_email, n_ip, n_card, n_phone (base spans), base_sha256, spans, n_added and points; see find_pii.
    points has the score of each of spans, joined by commas."""
    found = find_pii(df.select(F.col(id).alias("doc_id"), F.col(text).alias("text")), "text", "pii").drop("text")
    name = lambda s: F.element_at(F.array(*[F.lit(k.name) for k in KINDS]), s["rank"] + 1)
    joined = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", name(s), s["start"].cast("string"), s["end"].cast("string"))), ",")
    base = F.filter("pii", lambda s: s["rank"] < len(BASE))
    count = lambda rank: F.size(F.filter("pii", lambda s: s["rank"] == rank)).cast("long")
    return found.select(
        "doc_id",
        *[count(RANK[k]).alias(f"n_{k}") for k in BASE],
        F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("pii")).alias("spans"),
        F.size(F.filter("pii", lambda s: s["rank"] >= len(BASE))).cast("long").alias("n_added"),
        F.array_join(F.transform("pii", lambda s: s["points"].cast("string")), ",").alias("points"),
    )


def op11_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every whole text of documents."""
    return pii_report(table(spark, sf_dir, "documents"))


_CONFIRM_SQL = {
    "ip": "len(list_filter(string_split(m, '.'), lambda x: NOT regexp_matches(x, '^0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})$'))) = 0",
    "card": "length(regexp_replace(m, '[^0-9]', '', 'g')) BETWEEN 12 AND 19 AND list_sum(list_transform(range(length(regexp_replace(m, '[^0-9]', '', 'g'))), lambda i: "
    "(CAST(substr(reverse(regexp_replace(m, '[^0-9]', '', 'g')), i + 1, 1) AS BIGINT) * (1 + i % 2)) // 10 + (CAST(substr(reverse(regexp_replace(m, '[^0-9]', '', 'g')), i + 1, 1) AS BIGINT) * (1 + i % 2)) % 10)) % 10 = 0",
    "phone": "length(regexp_replace(m, '[^0-9]', '', 'g')) BETWEEN 9 AND 15",
    "iban": "list_reduce(list_prepend(0::BIGINT, list_transform(string_split(substr(replace(m, ' ', ''), 5) || substr(replace(m, ' ', ''), 1, 4), ''), lambda c: CAST(unicode(c) AS BIGINT))), "
    "lambda r, c: CASE WHEN c < 58 THEN (r * 10 + c - 48) % 97 ELSE (r * 100 + c - 55) % 97 END) = 1",
    "ssn": "NOT regexp_matches(m, '^(?:000|666|9)|-00-|0000$')",
    "secret": "regexp_matches(m, '[0-9]') AND regexp_matches(m, '[A-Za-z]')",
}


def _sql() -> str:
    out = ["WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents)"]
    for rank, k in enumerate(KINDS):
        ok = _CONFIRM_SQL.get(k.name, "true")
        if k.edges:
            ok = f"({ok}) AND NOT regexp_matches(right(b, {BEFORE}), '{k.edges[0]}') AND NOT regexp_matches(left(a, {AFTER}), '{k.edges[1]}')"
        near = f"translate(right(b, {BEFORE}) || '|' || left(a, {AFTER}), '{_UPPER}', '{_LOWER}')"
        word = lambda words, near=near: f"CASE WHEN regexp_matches({near}, '{_words(words)}') THEN {CONTEXT} ELSE 0 END" if words else "0"
        out.append(f"""m{rank} AS (SELECT r, i, m, b, a, sum(length(b) + length(m)) OVER (PARTITION BY r ORDER BY i) AS e FROM (
    SELECT r, generate_subscripts(ms, 1) AS i, unnest(ms) AS m, unnest(ps[:-2]) AS b, unnest(ps[2:]) AS a
    FROM (SELECT r, regexp_extract_all(t, '{k.plain}') AS ms, string_split_regex(t, '{k.plain}') AS ps FROM d) WHERE len(ms) > 0)),
s{rank} AS (SELECT r, {rank} AS k, CAST(e - length(m) AS BIGINT) AS s, CAST(e AS BIGINT) AS e, greatest(0, least(100, {k.points} + {word(k.raises)} - {word(k.lowers)})) AS p FROM m{rank} WHERE {ok})""")
    every = " UNION ALL ".join(f"SELECT * FROM s{i}" + ("" if k.base else f" WHERE p >= {NEEDED}") for i, k in enumerate(KINDS))
    names = "[" + ", ".join(f"'{k.name}'" for k in KINDS) + "]"
    return ",\n".join(out) + f""",
f AS (SELECT r, k, s, e, p, ({names})[k + 1] || ':' || s || ':' || e AS x FROM ({every})),
g AS (SELECT r, {", ".join(f"count(*) FILTER (WHERE k = {RANK[b]}) AS n_{b}" for b in BASE)}, string_agg(x, ',' ORDER BY s, k) FILTER (WHERE k < {len(BASE)}) AS base,
  string_agg(x, ',' ORDER BY s, k) AS spans, count(*) FILTER (WHERE k >= {len(BASE)}) AS n_added, string_agg(CAST(p AS VARCHAR), ',' ORDER BY s, k) AS points FROM f GROUP BY r)
SELECT doc_id, {", ".join(f"CAST(coalesce(n_{b}, 0) AS BIGINT) AS n_{b}" for b in BASE)}, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans,
  CAST(coalesce(n_added, 0) AS BIGINT) AS n_added, coalesce(points, '') AS points FROM d LEFT JOIN g USING (r)
"""


OP11_SQL = _sql()
