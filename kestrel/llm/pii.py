"""Personal data by bootstrapped contextual extraction, in Spark expressions and joins only.

Seeds are e-mail addresses, IP addresses, payment card and phone numbers found by their formats. The two words
before a seed are a lexical pattern. In the graph of patterns and instances (seeds and other tokens with a digit),
a pattern's confidence is the sum of its instances' confidences over all occurrences of its two words in the
corpus, whatever follows; an instance that is no seed is as sure as its best pattern. A few rounds of joins and
sums propagate this, and tokens behind patterns of high confidence and support become identifiers (kind ``id``). These
act as seeds in their turn: patterns that they support are counted and weighed as well, until no identifier is added.

Counts of the patterns' occurrences cover every text: hashes of word pairs pass a bitmap of ``BITMAP`` places made
from the patterns (a constant size), and only those that pass are summed and joined. A pattern that has too many
occurrences in a part of the corpus already can't reach the confidence in the whole; parts of growing size drop such
patterns (two common words, in the main) before all texts are counted.

A null or empty text has no spans; repeated rows are searched each; extra columns are kept by ``redact`` and dropped
by ``find``; an empty table gives an empty one. Patterns are written so that they take linear time on long runs:
each starts at the beginning of a run or where the last match ended, and repeats possessively.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kestrel.llm.tables import keep

KINDS = ("email", "ip", "card", "phone")
CONTEXT_KIND = "id"
#: A pattern is used from this confidence and this number of distinct seeds.
MIN_CONFIDENCE = 0.6
MIN_SEEDS = 3
ROUNDS = 3
MIN_TOKEN = 6
BITMAP = 1 << 18
#: One text in so many is counted before all are.
PARTS = (256, 16)

_PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_TOKEN = r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9]*+[0-9][^\x20\x09-\x0D]*+"
_WHITE = r"[\x20\x09-\x0D]+"
_CONTEXT = r"(?:^|[\x20\x09-\x0D])([^\x20\x09-\x0D0-9@]+)[\x20\x09-\x0D]+([^\x20\x09-\x0D0-9@]+)[\x20\x09-\x0D]+$"
_TAIL = 200  # code points in front of a match that its context is read from; words that begin before them are no context


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def _valid(kind: str, m: Column) -> Column:
    if kind == "ip":
        short = lambda part: F.regexp_replace(part, "^0+", "")
        return F.forall(F.split(m, r"\."), lambda part: (F.length(short(part)) <= 3) & (F.coalesce(short(part).try_cast("int"), F.lit(0)) <= 255))
    if kind == "card":
        return F.length(_digits(m)).between(14, 19) & F.call_function("luhn_check", _digits(m))
    if kind == "phone":
        return F.length(_digits(m)).between(10, 15)
    return F.lit(True)


def _only_valid(kind: str) -> Column:
    return F.filter(f"_{kind}", lambda x: _valid(kind, x["m"]))


def _needs(kind: str, text: Column) -> Column:
    """A cheap test that every match's text passes."""
    return {"email": text.contains("@"), "phone": text.contains("+")}.get(kind, text.rlike("[0-9]"))


def _sums_before(lengths: Column, block: int = 256) -> Column:
    """For each place of an array its sum before that place, in blocks, so that long arrays aren't copied for each element."""
    zero, none = F.lit(0).cast("long"), F.array().cast("array<bigint>")

    def run(a: Column, start: Column) -> Column:
        return F.aggregate(a, F.struct(start.alias("total"), none.alias("list")),
                           lambda acc, x: F.struct((acc["total"] + x).alias("total"), F.concat(acc["list"], F.array(acc["total"])).alias("list")))["list"]

    blocks = F.transform(F.sequence(F.lit(1), F.greatest(F.size(lengths), F.lit(1)), F.lit(block)), lambda b: F.slice(lengths, b, F.lit(block)))
    named = F.transform(F.array(blocks), lambda bs: F.flatten(F.zip_with(
        bs, run(F.transform(bs, lambda b: F.aggregate(b, zero, lambda s, x: s + x)), zero), run)))
    return F.get(named, F.lit(0))


def _tail(gap: Column) -> Column:
    """The end of a gap; where it is cut a digit stands, which belongs to no word, so that a cut word is none."""
    return F.when(F.length(gap) > _TAIL, F.concat(F.lit("0"), F.substring(gap, -_TAIL, _TAIL))).otherwise(gap)


def _located(df: DataFrame, name: str, pattern: str, needed: Column) -> DataFrame:
    """Adds the array ``name`` of (m, before, start, end) of all matches of the pattern in _text: positions in code points."""
    empty = F.array().cast("array<string>")
    df = df.withColumns({
        "_gaps": F.when(needed, F.split("_text", pattern, -1)).otherwise(empty),
        "_found": F.when(needed, F.regexp_extract_all("_text", F.lit(pattern), F.lit(0))).otherwise(empty),
    })
    # each match comes after its gap and all pairs before
    df = df.withColumn("_pairs", F.when(F.size("_found") > 0, F.zip_with(
        "_found", F.slice("_gaps", F.lit(1), F.size("_found")),
        lambda m, gap: F.struct(m.alias("m"), _tail(gap).alias("before"), F.length(gap).cast("long").alias("skip"), F.length(m).cast("long").alias("n")))))
    df = df.withColumn("_starts", F.when(F.col("_pairs").isNotNull(), _sums_before(F.transform("_pairs", lambda p: p["skip"] + p["n"]))))
    placed = F.zip_with("_pairs", "_starts", lambda p, at: F.struct(
        p["m"].alias("m"), p["before"].alias("before"), (at + p["skip"]).alias("start"), (at + p["skip"] + p["n"]).alias("end")))
    kind = "array<struct<m:string,before:string,start:bigint,end:bigint>>"
    return df.withColumn(name, F.coalesce(placed.cast(kind), F.array().cast(kind))).drop("_gaps", "_found", "_pairs", "_starts")


def _context(before: Column) -> Column:
    """Hash of the two words in front, null without them."""
    w1, w2 = (F.regexp_extract(before, _CONTEXT, i) for i in (1, 2))
    return F.when(w2 != "", F.xxhash64(F.xxhash64(F.lower(w1)), F.xxhash64(F.lower(w2))))


def _sums_at(xs: str, edge: str, spans: str, other: str, spans_first: bool) -> Column:
    """For each of ``xs``, which are in order and apart, the number of spans whose ``other`` lies in front of its ``edge``
    (or there, if ``spans_first``)."""
    entry = lambda pos, first, n: F.struct(pos.alias("pos"), F.lit(0 if first else 1).alias("order"), F.lit(n).cast("long").alias("n"))
    entries = F.sort_array(F.concat(F.transform(xs, lambda x: entry(x[edge], not spans_first, 0)), F.transform(spans, lambda s: entry(s[other], spans_first, 1))))
    return F.transform(F.array(entries), lambda es: F.filter(
        F.zip_with(es, _sums_before(F.transform(es, lambda e: e["n"])), lambda e, k: F.when(e["n"] == 0, k)), lambda k: k.isNotNull()))[0]


def _free(df: DataFrame, xs: str, spans: str) -> DataFrame:
    """``df`` without those elements of its array ``xs`` that overlap a span: spans that start before an element's end,
    and don't end up to its start."""
    df = df.withColumns({"_started": _sums_at(xs, "end", spans, "start", False), "_ended": _sums_at(xs, "start", spans, "end", True)})
    marked = F.zip_with(F.arrays_zip("_started", "_ended"), xs, lambda k, x: F.struct((k["_started"] == k["_ended"]).alias("free"), x.alias("x")))
    return df.withColumn(xs, F.transform(F.filter(marked, lambda m: m["free"]), lambda m: m["x"])).drop("_started", "_ended")


def base(docs: DataFrame) -> DataFrame:
    """All columns of ``docs`` with _text, _key, _spans (start, rank, kind, end) in order, and _mentions of seeds and other
    tokens with their contexts: one for each occurrence of a context, so tokens that overlap a span are none."""
    df = docs.withColumn("_text", F.coalesce("text", F.lit("")))
    for kind in KINDS:
        df = _located(df, f"_{kind}", _PATTERNS[kind], _needs(kind, F.col("_text")))
        df = df.withColumn(f"_{kind}", _only_valid(kind))
    df = _located(df, "_token", _TOKEN, F.col("_text").rlike("[0-9]"))
    span = lambda i, kind: F.transform(f"_{kind}", lambda x: F.struct(
        x["start"].alias("start"), F.lit(i).alias("rank"), F.lit(kind).alias("kind"), x["end"].alias("end")))
    mention = lambda x, seed, m: F.struct(
        _context(x["before"]).alias("context"), m.alias("value"), x["start"].alias("start"),
        (x["start"] + F.length(m)).alias("end"), F.lit(seed).alias("seed"))
    # an address in front of an @ has the e-mail's context
    df = _free(df.withColumn("_alone", F.col("_ip")), "_alone", "_email")
    seeds = [F.transform({"ip": "_alone"}.get(kind, f"_{kind}"), lambda x: mention(x, True, x["m"])) for kind in KINDS]
    tokens = F.transform("_token", lambda x: mention(x, False, F.regexp_replace(x["m"], r"[^\p{L}\p{N}]+$", "")))
    known = lambda mentions: F.filter(mentions, lambda t: t["context"].isNotNull())
    df = df.withColumns({
        "_spans": F.sort_array(F.concat(*(span(i, kind) for i, kind in enumerate(KINDS)))),
        "_seeds": known(F.concat(*seeds)),
        "_tokens": known(F.filter(tokens, lambda t: F.length(t["value"]) >= MIN_TOKEN)),
        "_key": F.when(F.col("_text").rlike("[0-9@]"), F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.lit(":"), F.col("_text")))),
        **{f"n_{kind}": F.size(f"_{kind}").cast("long") for kind in KINDS},
    })
    df = _free(df.drop(*(f"_{kind}" for kind in KINDS), "_token", "_alone"), "_tokens", "_spans")
    return df.withColumn("_mentions", F.concat("_seeds", "_tokens")).drop("_seeds", "_tokens")


def _occurrences(docs: DataFrame, patterns: DataFrame) -> DataFrame:
    """(context, occurrences) of the patterns' word pairs over all texts."""
    places = [r[0] for r in patterns.select(F.pmod("context", F.lit(BITMAP)).cast("int")).distinct().collect()]  # BITMAP at most
    bits = bytearray(BITMAP)
    for p in places:
        bits[p] = 1
    words = docs.select(F.transform(F.array_remove(F.split(F.lower("text"), _WHITE), ""), lambda w: F.xxhash64(w)).alias("h"))
    pairs = words.withColumn("p", F.zip_with("h", F.slice("h", F.lit(2), F.greatest(F.size("h"), F.lit(1))), lambda a, b: F.when(b.isNotNull(), F.xxhash64(a, b))))
    may = F.filter("p", lambda x: F.substring(F.lit(bytes(bits)), F.pmod(x, F.lit(BITMAP)).cast("int") + 1, F.lit(1)) == F.lit(b"\x01"))
    return pairs.select(F.explode(may).alias("context")).groupBy("context").agg(F.count(F.lit(1)).alias("occurrences"))


def _counted(docs: DataFrame, mentions: DataFrame, contexts: DataFrame) -> DataFrame | None:
    """(context, occurrences) of those contexts that can reach the confidence; None if there are none."""
    supported = keep(mentions.groupBy("context").agg(F.count(F.lit(1)).alias("n")).join(contexts, "context"), "patterns")
    for part in (*PARTS, 1):
        if not supported.head(1):
            return None
        texts = docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(part)) == 0) if part > 1 else docs
        counted = supported.join(_occurrences(texts.select("text"), supported), "context", "left").withColumn("occurrences", F.coalesce("occurrences", F.lit(0)))
        # no more than all n mentions can be sure
        counted = counted.where(F.col("n") >= (F.col("occurrences") + 1) * MIN_CONFIDENCE)
        supported = keep(counted if part == 1 else counted.drop("occurrences"), "patterns")
    return supported.select("context", "occurrences") if supported.head(1) else None


def discover(docs: DataFrame, found: DataFrame) -> DataFrame | None:
    """(_key, extra array of (start, end)) of the tokens behind trusted patterns; None if no pattern has enough seeds.

    Instances of the confidence act as seeds for the contexts they appear in, with what is known of them, until no
    more come."""
    mentions = keep(found.where(F.size("_mentions") > 0).select("_key", F.inline("_mentions")), "mentions")
    seeds = mentions.where("seed").select("value").distinct().withColumn("sure", F.lit(1.0))
    acting, n_acting, tried, counted = seeds, -1, None, None
    while True:
        contexts = mentions.join(acting.select("value"), "value").groupBy("context").agg(F.countDistinct("value").alias("seeds")).where(F.col("seeds") >= MIN_SEEDS).select("context")
        contexts = keep(contexts if tried is None else contexts.join(tried, "context", "left_anti"), "contexts")
        tried = contexts if tried is None else keep(tried.union(contexts), "tried")
        more = _counted(docs, mentions, contexts)
        counted = counted if more is None else more if counted is None else keep(counted.union(more), "patterns")
        if counted is None:
            return None
        edges = keep(mentions.groupBy("context", "value").agg(F.count(F.lit(1)).alias("n"), F.max("seed").alias("seed")).join(counted, "context"), "edges")
        known = edges.groupBy("value").agg(F.max(F.col("seed").cast("double")).alias("own")).join(acting, "value", "left").select(
            "value", F.greatest("own", F.coalesce("sure", F.lit(0.0))).alias("sure"))
        for _ in range(ROUNDS):
            trust = (edges.join(known, "value").groupBy("context").agg((F.sum(F.col("n") * F.col("sure")) / (F.first("occurrences") + 1)).alias("trust")))
            trust = keep(trust, "trust")
            known = keep(edges.join(trust, "context").groupBy("value").agg(
                F.max(F.when(F.col("seed"), 1.0).otherwise(F.least("trust", F.lit(1.0)))).alias("sure")), "instances")
        now = known.where(F.col("sure") >= MIN_CONFIDENCE).join(seeds, "value", "left_anti")
        before, n_acting = n_acting, now.count()
        if n_acting in (0, before):
            break
        acting = keep(seeds.union(now), "acting")
    trusted = trust.where(F.col("trust") >= MIN_CONFIDENCE).select("context")
    fresh = mentions.where("not seed").join(trusted, "context", "left_semi").join(seeds, "value", "left_anti")
    return keep(fresh.groupBy("_key").agg(F.sort_array(F.collect_set(F.struct("start", "end"))).alias("extra")), "extra")


def _with_extra(found: DataFrame, extra: DataFrame | None) -> DataFrame:
    """_all: the base spans and those of ``extra`` that overlap none of them, in order."""
    if extra is None:
        return found.withColumn("_all", F.col("_spans"))
    joined = found.join(extra, "_key", "left")
    free = F.filter("extra", lambda e: ~F.exists("_spans", lambda s: (s["start"] < e["end"]) & (e["start"] < s["end"])))
    more = F.transform(free, lambda e: F.struct(e["start"].alias("start"), F.lit(len(KINDS)).alias("rank"), F.lit(CONTEXT_KIND).alias("kind"), e["end"].alias("end")))
    return joined.withColumn("_all", F.when(F.col("extra").isNull(), F.col("_spans")).otherwise(F.sort_array(F.concat("_spans", more)))).drop("extra")


def find(docs: DataFrame) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base, spans): base and all spans as arrays of (start, rank, kind, end)."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    counts = [f"n_{k}" for k in KINDS]
    found = keep(base(docs).select("doc_id", "_key", "_spans", "_mentions", *counts), "found")
    return _with_extra(found, discover(docs, found)).select("doc_id", *counts, F.col("_spans").alias("base"), F.col("_all").alias("spans"))


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with every span of the text replaced by its kind in brackets; n_chars, where there is one, follows."""
    # the input's columns travel as one struct, so that none of their names can clash with those made here
    columns = dict(docs.dtypes)
    # written once: a filter on what the patterns find would run all of them again
    found = keep(base(docs.select("doc_id", "text", F.struct(*docs.columns).alias("_row"))).select("_row", "_key", "_spans", "_mentions"), "found")
    found = _with_extra(found, discover(docs, found)).withColumn("_text", F.coalesce("_row.text", F.lit(""))).withColumn("text", F.col("_row.text"))
    # overlapping spans become one, named after the first
    merged = F.aggregate("_all", F.array().cast("array<struct<start:bigint,rank:int,kind:string,end:bigint>>"), lambda acc, s: F.when(
        (F.size(acc) > 0) & (s["start"] < F.get(acc, F.size(acc) - 1)["end"]),
        F.concat(F.slice(acc, F.lit(1), F.size(acc) - 1), F.array(F.struct(
            F.get(acc, F.size(acc) - 1)["start"].alias("start"), F.get(acc, F.size(acc) - 1)["rank"].alias("rank"),
            F.get(acc, F.size(acc) - 1)["kind"].alias("kind"), F.greatest(F.get(acc, F.size(acc) - 1)["end"], s["end"]).alias("end")))),
    ).otherwise(F.concat(acc, F.array(s))))
    piece = lambda frm, to: F.substring("_text", (frm + 1).cast("int"), (to - frm).cast("int"))
    ends = F.concat(F.array(F.lit(0).cast("long")), F.transform("_merged", lambda s: s["end"]))
    parts = F.zip_with(F.slice(ends, F.lit(1), F.size("_merged")), "_merged", lambda e, s: F.concat(piece(e, s["start"]), F.lit("["), F.upper(s["kind"]), F.lit("]")))
    rest = piece(F.get(ends, F.size("_merged")), F.length("_text").cast("long"))
    new = {"text": F.when(F.size("_all") == 0, F.col("text")).otherwise(F.concat(F.array_join(parts, ""), rest))}
    if "n_chars" in columns:
        new["n_chars"] = F.when(F.size("_all") == 0, F.col("_row.n_chars")).otherwise(F.length("_new").cast(columns["n_chars"]))
    out = found.withColumn("_merged", merged).withColumn("_new", new["text"])
    new["text"] = F.col("_new")
    return out.select(*(new.get(c, F.col("_row")[c]).alias(c) for c in columns))
