"""Secret scan with corpus-wide ownership frequency.

Patterns propose spans. Every span's value is hashed, and the hashes are counted
over the corpus by distinct owners and repositories: a value that many owners
have is a copied example, one that stays with its owner looks like a live
credential. Spans of the base patterns always stay; the frequencies tell which
of them are copied, and add bare occurrences that no base pattern sees:

- the value of an assignment somewhere in the corpus, standing alone elsewhere;
- a long word that mixes capitals, small letters and digits;

each only if it is owner-specific and overlaps no base span. Values leave a row
only as SHA-256. All work is done by DataFrame functions.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import prepare, stored


def _any_case(word: str) -> str:
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)


#: kind: (pattern, group that holds the value, least length of the value). Spans are whole matches. A run of one class
#: is matched whole or not at all, so its least length stands in the pattern; an assignment's must be checked
#: afterwards, as a short value still uses up its text.
BASE = {
    "assign": ("(" + "|".join(_any_case(w) for w in ("password", "passwd", "secret", "token", "api_?key")) + """)["']? *[:=] *["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    "access": ("AKIA[A-Z0-9]{12,}", 0, 16),
    "hex": ("[0-9a-f]{32,}", 0, 32),
}
#: A bare word: a whole run of these characters with a digit. The look-ahead runs once a run, so time is linear.
RUN = "[A-Za-z0-9+/_.-]"
WORD = f"(?<!{RUN})(?=[A-Za-z+/_.-]*+[0-9]){RUN}{{8,}}"
#: Length from which a mixed word looks like a credential by itself.
LONG_WORD = 20
KINDS = [*BASE, "owned"]
#: A value is a copied example if it has more owners than this, or more than one owner and more repositories than that.
MAX_OWNERS, MAX_REPOSITORIES = 2, 4


def _hash(value: Column) -> Column:
    """Of the value without closing dots and equals signs."""
    return F.unhex(F.sha2(F.regexp_replace(value, "[.=]+$", ""), 256))


def _matches(text: Column, pattern: str, group: int, kind: int) -> Column:
    """Leftmost matches in order: place, kind, characters before it since the last match, its own, the value's, and its hash.

    Splitting at the pattern gives the text between matches, so places need no search.
    """
    found, between = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else found
    cells = F.transform(F.arrays_zip(found.alias("m"), values.alias("v"), F.slice(between, 1, F.size(found)).alias("g")), lambda x, i: F.struct(
        i.alias("at"), F.lit(kind).alias("kind"), F.length(x["g"]).cast("long").alias("before"), F.length(x["m"]).cast("long").alias("size"),
        F.length(x["v"]).alias("chars"), _hash(x["v"]).alias("hash"),
        (x["v"].rlike("[A-Z]") & x["v"].rlike("[a-z]")).alias("mixed"), x["v"].rlike("[A-Za-z]").alias("letters")))
    # most texts have no match: they are scanned once and nothing is built
    return F.when(text.rlike(pattern), cells).otherwise(F.array().cast("array<struct<at:int,kind:int,before:bigint,size:bigint,chars:int,hash:binary,mixed:boolean,letters:boolean>>"))


def ownership(found: DataFrame) -> DataFrame:
    """``hash`` with its distinct ``owners`` and ``repositories`` (repositories of different owners differ), and whether an assignment has it."""
    pairs = found.groupBy("hash", "owner", "repository").agg(F.max(F.col("kind") == 0).alias("assigned"))
    owners = pairs.groupBy("hash", "owner").agg(F.count("*").alias("n"), F.max("assigned").alias("assigned"))
    return owners.groupBy("hash").agg(F.count("*").alias("owners"), F.sum("n").alias("repositories"), F.max("assigned").alias("assigned"))


def copied() -> Column:
    return (F.col("owners") > MAX_OWNERS) | ((F.col("owners") > 1) & (F.col("repositories") > MAX_REPOSITORIES))


def scan(docs: DataFrame, owner: Column, repository: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id and ``spans``, an array of structs start, end (code points, exclusive), kind
    (index into KINDS), owners, repositories, copied; in order of start, kind, end.

    Null text is empty, a null owner or repository is one of its own. Repeated
    rows are scanned alike and count once in the frequencies if their owner and
    repository are the same. Texts of any length are scanned whole. An empty
    table gives no rows; other columns are not looked at.
    """
    prepare(docs.sparkSession)
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.monotonically_increasing_id().alias("rid"), F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"),
                       *[F.coalesce(F.concat(F.lit("="), x.cast("string")), F.lit("")).alias(name) for x, name in ((owner, "owner"), (repository, "repository"))])
    cells = [_matches(text, p, group, k) for k, (p, group, _) in enumerate(BASE.values())] + [_matches(text, WORD, 0, len(BASE))]
    # one pass over the texts; what is kept has no text
    found = stored(rows.select("rid", "doc_id", "owner", "repository", F.concat(*cells).alias("cells")), "secret-candidates")

    each = found.filter(F.size("cells") > 0).select("rid", "owner", "repository", F.inline("cells"))
    run = Window.partitionBy("rid", "kind").orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    each = each.withColumn("end", F.sum(F.col("before") + F.col("size")).over(run)).withColumn("start", F.col("end") - F.col("size"))
    least = reduce(lambda c, x: c.when(F.col("kind") == x[0], x[1]), [(k, v[2]) for k, v in enumerate(BASE.values())], F.when(F.col("kind") == len(BASE), 8))
    each = each.filter((F.col("chars") >= least) & ((F.col("kind") < len(BASE)) | F.col("letters")))
    # words that touch a base span are left to it
    base = F.col("kind") < len(BASE)
    line = Window.partitionBy("rid").orderBy("start", "kind")
    each = each.withColumn("left", F.max(F.when(base, F.col("end"))).over(line.rowsBetween(Window.unboundedPreceding, Window.currentRow))) \
        .withColumn("right", F.min(F.when(base, F.col("start"))).over(line.rowsBetween(Window.currentRow, Window.unboundedFollowing)))
    each = each.filter(base | (F.coalesce(F.col("left") <= F.col("start"), F.lit(True)) & F.coalesce(F.col("right") >= F.col("end"), F.lit(True))))
    each = stored(each.select("rid", "owner", "repository", "start", "end", "kind", "hash", (F.col("mixed") & (F.col("chars") >= LONG_WORD)).alias("random")), "secret-spans")

    # stored, so that both sides of the join are plain shuffles, which a hot value's rows can split
    known = stored(ownership(each), "secret-owners")
    judged = each.drop("owner", "repository").join(known, "hash").withColumn("copied", copied())
    judged = judged.filter(base | (~F.col("copied") & (F.col("assigned") | F.col("random"))))
    spans = judged.groupBy("rid").agg(F.sort_array(F.collect_list(F.struct("start", "kind", "end", "owners", "repositories", "copied"))).alias("spans"))
    none = F.array().cast("array<struct<start:bigint,kind:int,end:bigint,owners:bigint,repositories:bigint,copied:boolean>>")
    return found.select("rid", "doc_id").join(spans, "rid", "left").select("doc_id", F.coalesce("spans", none).alias("spans"))


def written(spans: Column) -> Column:
    """``kind:start:end`` of all spans, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.get(names, x["kind"]), x["start"], x["end"])), ",")


def digests(scanned: DataFrame) -> DataFrame:
    """Counts by base kind, digest of the base spans, all spans as text, and how many are added, copied, and owner-specific."""
    base = F.filter("spans", lambda x: x["kind"] < len(BASE))

    def count(test) -> Column:
        return F.size(F.filter("spans", test)).cast("long")

    def of_kind(k: int) -> Column:
        return count(lambda x: x["kind"] == k)

    return scanned.select(
        "doc_id", *[of_kind(k).alias(f"n_{kind}") for k, kind in enumerate(BASE)],
        F.sha2(written(base), 256).alias("base_sha256"), written(F.col("spans")).alias("spans"),
        of_kind(len(BASE)).alias("n_added"), count(lambda x: x["copied"]).alias("n_copied"), count(lambda x: ~x["copied"]).alias("n_live"))
