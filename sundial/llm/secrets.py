"""Secret scans: strong patterns in every text, and weak candidates that only count together.

Strong spans (assign, access, hex) are reported as they are. Weak ones are linked: bare random-looking values
(`value`), account names (`login`) and service addresses (`endpoint`) are cut into position bins, the parts they need are
summarised by scope and bin, and an interval join decides. A `value` needs an identifier (access or login) nearby, a
`login` needs a secret (assign, hex or value), an `endpoint` needs both. Scopes are paragraphs (text between empty
lines); nearby means at most `reach` code points apart. Each side of the join is one row a bin, so a text full of
secrets makes no pairs. Everything is built-in functions: spans come from the matches and the gaps between them.

Positions are code points from 0, the end is exclusive. Null text is empty and has no spans. Equal texts are linked once and share the
result; every input row gives one output row, repeated and null doc_ids included.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sundial.llm.shared import bounded, saved

# The strong patterns, in the order of their kinds.
KEYWORD = r"""(?i:password|passwd|secret|token|api_?key)"""
ASSIGN = r"""(""" + KEYWORD + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"""AKIA[A-Z0-9]{12,}"""
HEX = r"""[0-9a-f]{32,}"""
KINDS = ["assign", "access", "hex", "value", "login", "endpoint"]

# Own choice: the weak patterns.
VALUE = r"[A-Za-z0-9+/=_-]{20,}"
LOGIN = r"""(?i:user(?:name)?|login|account|client_?id)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.@-]+"""
ENDPOINT = r"""(?:https?|ftp|ssh|jdbc:[a-z]+|postgres(?:ql)?|mysql|mongodb|redis|amqp)://[^\s"'<>]+"""
REACH = 200
CHUNK = 128
#: Texts with linked spans (some dozens of bytes each) that may be broadcast.
BROADCAST_TEXTS = 100_000

SPAN = "struct<start:int,kind:int,end:int>"
NO_SPANS = f"array<{SPAN}>"


def _ends(lengths: Column) -> Column:
    """Running sums of an array, chunk by chunk so that long arrays stay cheap."""
    def run(values: Column, first: Column) -> Column:
        begin = F.struct(first.alias("at"), F.array().cast("array<int>").alias("ends"))
        return F.aggregate(values, begin, lambda a, x: F.struct((a.at + x).alias("at"), F.concat(a.ends, F.array(a.at + x)).alias("ends")), lambda a: a.ends)

    chunks = F.transform(F.sequence(F.lit(0), F.floor((F.size(lengths) - 1) / CHUNK).cast("int")), lambda c: F.slice(lengths, c * CHUNK + 1, CHUNK))
    folded = F.aggregate(chunks, F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<at:int,part:array<int>>>").alias("parts")),
                         lambda a, x: F.struct((a.at + F.aggregate(x, F.lit(0), lambda s, v: s + v)).alias("at"),
                                               F.concat(a.parts, F.array(F.struct(a.at.alias("at"), x.alias("part")))).alias("parts")), lambda a: a.parts)
    return F.flatten(F.transform(folded, lambda c: run(c.part, c["at"])))


def _spans(text: Column, pattern: str, kind: int, present: Column, keep=None) -> Column:
    """Spans of all matches; only evaluated where `present` holds."""
    matches, gaps = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)
    found = F.zip_with(matches, F.slice(gaps, 1, F.size(matches)), lambda m, g: F.struct(m.alias("match"), F.length(m).alias("size"), (F.length(m) + F.length(g)).alias("step")))
    ends = _ends(F.transform(found, lambda x: x["step"]))
    placed = F.zip_with(found, ends, lambda x, e: F.struct(x["match"].alias("match"), F.struct((e - x["size"]).alias("start"), F.lit(kind).alias("kind"), e.alias("end")).alias("span")))
    if keep is not None:
        placed = F.filter(placed, lambda x: keep(x["match"]))
    return F.when(present & text.rlike(pattern), F.transform(placed, lambda x: x["span"])).otherwise(F.array().cast(NO_SPANS))


def _joined(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    ordered = F.array_sort(spans)
    return F.concat_ws(",", F.transform(ordered, lambda s: F.concat(F.get(names, s["kind"]), F.lit(":"), s["start"].cast("string"), F.lit(":"), s["end"].cast("string"))))


def _overlaps(spans: Column, span: Column) -> Column:
    return F.exists(spans, lambda o: (o["start"] < span["end"]) & (span["start"] < o["end"]))


def _text(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def strong_spans(df: DataFrame, text: str = "text") -> DataFrame:
    """df with arrays of strong spans and of weak ones that overlap no strong one."""
    own = _text(text)
    signs = own.rlike("[:=]")
    return (df.select("*",
                      _spans(own, ASSIGN, 0, signs, lambda m: F.length(F.regexp_extract(m, ASSIGN, 2)) >= 8).alias("__assign"),
                      _spans(own, ACCESS, 1, F.contains(own, F.lit("AKIA"))).alias("__access"),
                      _spans(own, HEX, 2, F.lit(True)).alias("__hex"),
                      (signs | F.contains(own, F.lit("AKIA"))).alias("__maybe"))
            .select("*", F.concat("__assign", "__access", "__hex").alias("__strong"))
            .select("*", _spans(own, VALUE, 3, F.col("__maybe"), lambda m: m.rlike("[0-9]") & m.rlike("[A-Za-z]")).alias("__value"), _spans(own, LOGIN, 4, signs).alias("__login"),
                    _spans(own, ENDPOINT, 5, signs & F.contains(own, F.lit("://"))).alias("__endpoint"))
            .select("*", F.filter(F.concat("__value", "__login", "__endpoint"), lambda s: ~_overlaps(F.col("__strong"), s)).alias("__weak")))


def linked(scanned: DataFrame, text: str = "text", reach: int = REACH) -> DataFrame:
    """Weak spans of each text (by its hash) whose complementary parts occur in the same scope and within reach."""
    has = lambda kinds: F.exists(F.concat("__strong", "__weak"), lambda s: s["kind"].isin(kinds))
    texts = (scanned.where((F.size("__weak") > 0) & has([1, 4]) & has([0, 2, 3]))
             .select("__key", "__strong", "__weak", _spans(_text(text), r"\n[ \t]*\n", 9, F.lit(True)).alias("__breaks"))
             .dropDuplicates(["__key"]))
    scope = lambda s: F.size(F.filter("__breaks", lambda b: b["end"] <= s["start"]))
    parts = texts.select("__key", F.explode(F.transform(F.concat("__strong", "__weak"), lambda s: F.struct(s.alias("span"), scope(s).alias("scope")))).alias("p"))
    parts = parts.select("__key", "p.scope", "p.span.*")
    role = F.when(F.col("kind").isin(1, 4), "id").when(F.col("kind").isin(0, 2, 3), "secret")
    bins = (parts.withColumn("role", role).where("role IS NOT NULL")
            .withColumn("bin", F.explode(F.sequence(F.floor(F.col("start") / reach), F.floor((F.col("end") - 1) / reach))))
            .groupBy("__key", "scope", "role", "bin").agg(F.min("start").alias("least"), F.max("end").alias("most")))
    need = F.when(F.col("kind") == 3, F.array(F.lit("id"))).when(F.col("kind") == 4, F.array(F.lit("secret"))).otherwise(F.array(F.lit("id"), F.lit("secret")))
    weak = (parts.where("kind >= 3").withColumn("role", F.explode(need))
            .withColumn("bin", F.explode(F.sequence(F.floor((F.col("start") - reach) / reach), F.floor((F.col("end") + reach) / reach)))))
    near = (F.col("most") >= F.col("start") - reach) & (F.col("least") <= F.col("end") + reach)
    met = weak.join(bins, ["__key", "scope", "role", "bin"]).where(near).select("__key", "start", "kind", "end", "role").distinct()
    whole = met.groupBy("__key", "start", "kind", "end").agg(F.count("*").alias("n")).where("n = CASE WHEN kind = 5 THEN 2 ELSE 1 END")
    return whole.groupBy("__key").agg(F.collect_list(F.struct("start", "kind", "end")).alias("__linked"))


RESULTS = ("assign_spans", "access_spans", "hex_spans", "strong_spans", "all_spans")


def scan(documents: DataFrame, keep: list[str], text: str = "text", reach: int = REACH, results: tuple[str, ...] = RESULTS) -> DataFrame:
    """Columns `keep` with the spans of every row's text (arrays of start, kind, end): by strong kind, strong, all.

    Null and empty texts have none. Kept columns may have any name but those of `results`, which is an error; give other result
    names then. Repeated rows are rows of their own.
    """
    if clash := set(results) & set(keep):
        raise ValueError(f"kept columns are named like results: {sorted(clash)}")
    own = documents.select(F.struct(*keep).alias("__kept"), F.col(text).alias("__text"), F.xxhash64(_text(text), F.length(_text(text))).alias("__key"))
    scanned = strong_spans(own, "__text")
    found = bounded(saved(linked(scanned, "__text", reach), "linked"), BROADCAST_TEXTS)
    spans = [F.col("__assign"), F.col("__access"), F.col("__hex"), F.col("__strong"), F.concat("__strong", F.coalesce("__linked", F.array().cast(NO_SPANS)))]
    return (scanned.select("__kept", "__key", "__assign", "__access", "__hex", "__strong").join(found, "__key", "left")
            .select(*[F.col("__kept").getField(c).alias(c) for c in keep], *[s.alias(n) for s, n in zip(spans, results, strict=True)]))


def report(documents: DataFrame) -> DataFrame:
    """doc_id, counts of strong spans, the digest of their list, and the list of all spans."""
    return scan(documents, ["doc_id"]).select(
        "doc_id", F.size("assign_spans").cast("long").alias("n_assign"), F.size("access_spans").cast("long").alias("n_access"),
        F.size("hex_spans").cast("long").alias("n_hex"), F.sha2(_joined(F.col("strong_spans")), 256).alias("base_sha256"), _joined(F.col("all_spans")).alias("spans"))


def redacted(text: Column, spans: Column, mark: str = "[secret]") -> Column:
    """Text with every span replaced; overlapping and touching spans are one."""
    ordered = F.array_sort(spans)
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts"))
    done = F.aggregate(ordered, start, lambda a, s: F.when(s["end"] <= a["at"], a).otherwise(F.struct(
        s["end"].alias("at"), F.concat(a["parts"], F.when(s["start"] < a["at"], F.array().cast("array<string>")).otherwise(
            F.array(F.substring(text, a["at"] + 1, s["start"] - a["at"]), F.lit(mark)))).alias("parts"))))
    return F.when(F.size(spans) == 0, text).otherwise(F.concat(F.array_join(done["parts"], ""), F.substring(text, done["at"] + 1, F.length(text))))
