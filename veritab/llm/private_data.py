"""Operator 13: personal data by bootstrapped contextual extraction, in DataFrame functions only.

1. Base spans. Four fixed patterns (email, ip, card, phone), leftmost and not overlapping within a kind;
   matches that fail their kind's test go, without a retry. Places are running sums of the lengths of
   matches and of the text between them; only matches are shuffled for that, by their text.
2. Candidates. Looser shapes of each kind (``LOOSE``) mark what could be an identifier that no fixed
   pattern takes: an address without a dot, a dotted number of other length, a long number that fails the
   check digit, a number in telephone form without the plus. Those that overlap a base span go.
3. Patterns. Every base span and candidate has up to two lexical patterns: the two words before it, and
   the word before with the word after it. Letters are compared in lower case, digits as one class. A
   pattern next to the start or end of the text has fewer words; one without any word is none.
4. Graph. Occurrences are counted into edges (pattern, kind, identifier) before any shuffle of them, so
   copies of a text add nothing. In each of ``ROUNDS`` rounds a pattern's confidence for a kind is the
   belief of its different identifiers of that kind, over their number plus one; a candidate's belief is the
   highest confidence of its patterns for its kind. Seeds keep belief 1. Patterns need
   ``SUPPORT`` identifiers with a belief of ``TRUST``. Scores are joined by their keys; hot patterns and
   identifiers are aggregated before the shuffle.
5. Candidate places with a pattern whose confidence is at least ``TRUST`` join the spans. Base spans stay.

Defined results: a null or empty text has no spans; repeated rows give repeated results but count once as
evidence; an empty table gives no rows. Spans are counted in code points. Where two added spans overlap,
both stay. Only doc_id and text are read, so other columns may have any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .shared import Scratch, table

KINDS = ("email", "ip", "card", "phone")
#: The fixed patterns. A quantifier with a second + gives nothing back, which changes no match here: what
#: follows it never starts with a character that it takes. The looks behind keep a failed run of
#: characters from being tried again at each of its characters; \\G allows a start right after a match.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What can be an identifier of the kind in a known context.
LOOSE = {
    "email": r"(?<![^\s@<>(),;:\"])[^\s@<>(),;:\"]++@[^\s@<>(),;:\"]*[A-Za-z0-9]",
    "ip": r"(?<![0-9.])[0-9]++(?:\.[0-9]++){3,7}+(?!\.?[0-9])",
    "card": r"(?<![0-9])[0-9](?:[\x20-]?[0-9]){11,18}+(?![0-9])",
    "phone": r"(?<![0-9+(])(?:\([0-9]{2,5}\)\x20?)?[0-9]{2,5}(?:[\x20.-][0-9]{2,5}){1,4}+(?![0-9])",
}
#: Rounds of scoring, different identifiers behind a pattern, least confidence that counts.
ROUNDS, SUPPORT, TRUST = 3, 3, 0.75

#: A number up to 255, with leading zeros.
_BYTE = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])"
_SPAN = "array<struct<start:long,at:int,end:long>>"
_HITS = "array<struct<at:int,base:boolean,value:string,size:long,tail:string,head:string>>"


def _hits(kind: str, pattern: str, base: bool) -> Column:
    """Per match of a pattern (value) the length of the text between it and the match before, that text's
    end (tail) and beginning (head); last, without a value, the text after all matches."""
    text = F.col("text")
    gaps = F.transform(F.split(text, pattern, -1), lambda g: F.struct(
        F.length(g).cast("long").alias("size"), F.right(g, F.lit(80)).alias("tail"), F.left(g, F.lit(40)).alias("head")))
    pairs = F.arrays_zip(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("value"), gaps.alias("gap"))
    hits = F.transform(pairs, lambda x: F.struct(F.lit(KINDS.index(kind)).alias("at"), F.lit(base).alias("base"), x["value"].alias("value"),
                                                 x["gap"]["size"].alias("size"), x["gap"]["tail"].alias("tail"), x["gap"]["head"].alias("head")))
    needed = {"email": "@", "phone": "[+]" if base else "[0-9]"}.get(kind, "[0-9]")
    return F.when(text.rlike(needed), hits.cast(_HITS)).otherwise(F.array().cast(_HITS))


def _passes() -> Column:
    """A match of a fixed pattern is one of its kind."""
    value, digits = F.col("value"), F.regexp_replace("value", "[^0-9]", "")
    short = F.length(digits).between(12, 19)
    return (F.when(F.col("at") == KINDS.index("ip"), value.rlike(rf"^{_BYTE}(?:\.{_BYTE}){{3}}$"))
            .when(F.col("at") == KINDS.index("card"), short & F.call_function("luhn_check", F.when(short, digits).otherwise("1")))
            .when(F.col("at") == KINDS.index("phone"), F.length(digits).between(9, 15))
            .otherwise(True))


def _normal(words: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(words), "[0-9]", "0"), r"\s+", " ")


def hits_of(docs: DataFrame) -> DataFrame:
    """rid, doc_id, hits of every row; rid numbers the rows of a table that is then written."""
    hits = [_hits(k, pattern, base) for base, patterns in ((True, BASE), (False, LOOSE)) for k, pattern in patterns.items()]
    return (docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
            .select(F.monotonically_increasing_id().alias("rid"), "doc_id", F.concat(*hits).alias("hits")))


def occurrences_of(rows: DataFrame) -> DataFrame:
    """rid, start, at, end, base, value, before, after of every base span and every candidate.

    Places are running sums of lengths over one text's matches of a pattern."""
    own = Window.partitionBy("rid", "at", "base").orderBy("place")
    return (rows.where(F.size("hits") > 0).select("rid", F.posexplode("hits").alias("place", "h")).select("rid", "place", "h.*")
            .withColumn("end", F.sum(F.col("size") + F.coalesce(F.length("value"), F.lit(0))).over(own))
            .withColumn("head", F.lead("head").over(own))
            .where("value is not null").where(~F.col("base") | _passes())
            .select("rid", (F.col("end") - F.length("value")).alias("start"), "at", "end", "base",
                    F.lower(F.when(F.col("at") >= KINDS.index("card"), F.regexp_replace("value", r"[\s().+-]", "")).otherwise(F.col("value"))).alias("value"),
                    _normal(F.regexp_extract("tail", r"((?:\S+\s+)?\S+\s*)$", 1)).alias("before"),
                    _normal(F.regexp_extract("head", r"^(\s*\S+)", 1)).alias("after")))


def _joined(spans: Column) -> Column:
    """kind:start:end by start, then kind as listed, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", F.element_at(names, s["at"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def _patterns(occurrences: DataFrame) -> DataFrame:
    """One row per occurrence and pattern."""
    last = F.regexp_extract("before", r"(\S+\s*)$", 1)
    two = F.when(F.trim("before") != "", F.concat(F.lit("2|"), "before"))
    around = F.when((F.trim(last) != "") & (F.trim("after") != ""), F.concat(F.lit("1|"), last, F.lit("|"), "after"))
    return (occurrences.withColumn("pattern", F.explode(F.array_compact(F.array(two, around))))
            .select("rid", "start", "at", "end", "base", "value", "pattern"))


def _free(occurrences: DataFrame) -> DataFrame:
    """Base occurrences, and candidates that overlap none of their text's."""
    up = Window.partitionBy("rid").orderBy("start", "end").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    down = (Window.partitionBy("rid").orderBy(F.col("start").desc(), F.col("end").desc())
            .rangeBetween(Window.unboundedPreceding, Window.currentRow))  # a frame to the end of the text is summed anew for every row
    before = F.max(F.when(F.col("base"), F.col("end"))).over(up)
    after = F.min(F.when(F.col("base"), F.col("start"))).over(down)
    return (occurrences.withColumn("reach", before).withColumn("next", after)
            .where(F.col("base") | ((F.coalesce("reach", F.lit(0)) <= F.col("start")) & (F.coalesce("next", F.col("end")) >= F.col("end"))))
            .drop("reach", "next"))


def confident_patterns(scratch: Scratch, edges: DataFrame, rounds: int = ROUNDS, support: int = SUPPORT, trust: float = TRUST) -> DataFrame:
    """(pattern, at, confidence) of the patterns that may extract.

    ``edges``: different (pattern, at, value, seed). An identifier that is a seed anywhere has belief 1."""
    belief = edges.groupBy("at", "value").agg(F.max(F.col("seed").cast("double")).alias("belief"))
    belief = scratch.save(belief, "belief-0")
    patterns = None
    for step in range(1, rounds + 1):
        known = edges.join(belief, ["at", "value"])
        strong = F.col("belief") >= trust
        patterns = (known.groupBy("pattern", "at")
                    .agg((F.sum("belief") / (F.count("*") + 1)).alias("confidence"), F.sum(strong.cast("long")).alias("many"))
                    .where(F.col("many") >= support).select("pattern", "at", "confidence"))
        patterns = scratch.save(patterns, f"patterns-{step}")
        if step < rounds:
            better = edges.join(patterns, ["pattern", "at"]).groupBy("at", "value").agg(F.max("confidence").alias("confidence"))
            belief = scratch.save(belief.join(better, ["at", "value"], "left")
                                  .select("at", "value", F.greatest("belief", F.coalesce("confidence", F.lit(0.0))).alias("belief")), f"belief-{step}")
    return patterns.where(F.col("confidence") >= trust)


def private_spans(docs: DataFrame, rounds: int = ROUNDS, support: int = SUPPORT, trust: float = TRUST) -> DataFrame:
    """doc_id, base, added: arrays of (start, kind number, end) of every row."""
    scratch = Scratch(docs.sparkSession, "private-data")
    rows = scratch.save(hits_of(docs), "rows")
    occurrences = scratch.save(occurrences_of(rows), "occurrences")
    marked = scratch.save(_patterns(_free(occurrences)), "marked")
    edges = scratch.save(marked.groupBy("pattern", "at", "value").agg(F.max("base").alias("seed")), "edges")
    # a pattern without seeds and an identifier without such a pattern can gain nothing at first, but may in a later round
    patterns = confident_patterns(scratch, edges, rounds, support, trust)
    added = (marked.where("not base").join(patterns, ["pattern", "at"])
             .groupBy("rid").agg(F.collect_set(F.struct("start", "at", "end")).cast(_SPAN).alias("added")))
    span = F.struct("start", "at", "end")
    base = occurrences.where("base").groupBy("rid").agg(F.collect_list(span).cast(_SPAN).alias("base"))
    none = F.array().cast(_SPAN)
    return (rows.select("rid", "doc_id").join(base, "rid", "left").join(added, "rid", "left")
            .select("doc_id", F.coalesce("base", none).alias("base"), F.coalesce("added", none).alias("added")))


def op13_private_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = private_spans(table(spark, sf_dir, "documents").select("doc_id", "text"))

    def number(at: int) -> Column:
        return F.size(F.filter("base", lambda s: s["at"] == at)).cast("long").alias(f"n_{KINDS[at]}")

    return found.select("doc_id", *map(number, range(len(KINDS))), F.sha2(_joined(F.col("base")), 256).alias("base_sha256"),
                        _joined(F.concat("base", "added")).alias("spans"))
