"""Secret scan with corpus-wide ownership: who holds a candidate decides what it is.

Column expressions only. Candidates of every document are hashed, and each hash is counted over distinct owners and
repositories: one that many owners hold is a copied example, one that a single owner holds looks live.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sampleloom.llm.frames import table
from sampleloom.llm.registry import query
from sampleloom.session import settled

ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: The length limits are part of these patterns: a run that is too short holds no longer one.
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
#: Other long tokens with letters and digits; a span of kind ``owner`` if one owner alone holds it.
TOKEN = r"[A-Za-z0-9+/_-]{24,}"
MIN_VALUE = 8
#: From so many owners on a candidate is a widely copied example.
EXAMPLE_OWNERS = 3
KINDS = ("assign", "access", "hex", "owner")
_SPAN = "struct<start:int,kind:int,end:int,value:string>"


def _spans(text: Column, pattern: str, kind: int, group: int = 0) -> Column:
    """Leftmost non-overlapping matches as (start, kind, end, value), in code points."""
    gaps = F.transform(F.split(text, pattern, -1), lambda x: F.length(x))
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else hits
    steps = F.arrays_zip(F.slice(gaps, 1, F.greatest(F.size(hits), F.lit(0))).alias("gap"), hits.alias("hit"), values.alias("value"))
    none = F.array().cast(f"array<{_SPAN}>")

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + x["gap"]
        end = start + F.length(x["hit"])
        one = F.struct(start.alias("start"), F.lit(kind).alias("kind"), end.alias("end"), x["value"].alias("value"))
        return F.struct(end.alias("at"), F.array_append(acc["out"], one).alias("out"))

    return F.aggregate(steps, F.struct(F.lit(0).alias("at"), none.alias("out")), step, lambda acc: acc["out"])


def candidates(text: Column) -> Column:
    """All candidate spans of a text, by start, then kind. Null counts as empty."""
    text = F.coalesce(text, F.lit(""))
    none = F.array().cast(f"array<{_SPAN}>")
    when = lambda test, spans: F.when(test, spans).otherwise(none)
    assign = F.filter(_spans(text, ASSIGN, 0, 2), lambda x: F.length(x["value"]) >= MIN_VALUE)
    token = F.filter(_spans(text, TOKEN, 3), lambda x: x["value"].rlike("[0-9]") & x["value"].rlike("[A-Za-z]"))
    return F.array_sort(F.concat(
        when(text.rlike(ASSIGN), assign), when(F.contains(text, F.lit("AKIA")), _spans(text, ACCESS, 1)),
        when(text.rlike(HEX), _spans(text, HEX, 2)), when(text.rlike(TOKEN), token)))


def ownership(rows: DataFrame, owner: str, repository: str) -> DataFrame:
    """``(secret, owners, repositories)`` of rows with a ``secret`` hash.

    Every step is a partial sum before its shuffle, so one secret with a third of all rows moves a row from each task.
    """
    per_repo = rows.groupBy("secret", owner, repository).agg(F.count(F.lit(1)).alias("n"))
    per_owner = per_repo.groupBy("secret", owner).agg(F.count(F.lit(1)).alias("repositories"))
    return per_owner.groupBy("secret").agg(F.count(F.lit(1)).alias("owners"), F.sum("repositories").alias("repositories"))


def _print(spans: Column) -> Column:
    name = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(
        ":", F.element_at(name, x["kind"] + 1), x["start"].cast("string"), x["end"].cast("string"))), ",")


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source",
                 repository_col: str = "doc_id", example_owners: int = EXAMPLE_OWNERS, keep: list[str] | None = None) -> DataFrame:
    """``keep`` (default: the id) of each row and its ``spans``: (start, kind, end, value, owners, repositories, class).

    Kinds: 0 assign, 1 access, 2 hex, and 3 for other long tokens that one owner alone holds. Class ``example`` is held by
    at least ``example_owners`` owners, ``live`` by one, ``shared`` is between. A null owner or repository counts as one more;
    a null or empty text has no spans; repeated rows are scanned each. A kept column named ``spans`` is replaced.
    """
    keep = [c for c in (keep if keep is not None else [id_col]) if c != "spans"]
    found = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"), F.col(owner_col).alias("owner"),
                        F.col(repository_col).alias("repository"), F.monotonically_increasing_id().alias("at"),
                        candidates(F.col(text_col)).alias("spans"))
    found = settled(found)  # without texts: the scan is done once, and the row numbers stay
    each = found.where(F.size("spans") > 0).select("at", "owner", "repository", F.explode("spans").alias("s"))
    each = each.withColumn("secret", F.sha2(F.col("s.value"), 256))
    held = ownership(each, "owner", "repository")
    cls = (F.when(F.col("owners") >= example_owners, "example").when(F.col("owners") == 1, "live").otherwise("shared"))
    judged = each.join(held, "secret").where("s.kind < 3 or owners = 1").select(
        "at", F.struct("s.start", "s.kind", "s.end", "s.value", "owners", "repositories", cls.alias("class")).alias("s"))
    per_row = judged.groupBy("at").agg(F.array_sort(F.collect_list("s")).alias("spans"))
    empty = F.array().cast(per_row.schema["spans"].dataType)
    plain = found.where(F.size("spans") == 0).select("row.*", empty.alias("spans"))
    hits = found.where(F.size("spans") > 0).select("row", "at").join(per_row, "at", "left")
    return plain.unionByName(hits.select("row.*", F.coalesce("spans", empty).alias("spans")))


@query("op3_secret_scan")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_secrets(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda x: x["kind"] < 3)
    count = lambda test: F.size(F.filter("spans", test)).cast("long")
    return found.select(
        "doc_id", count(lambda x: x["kind"] == 0).alias("n_assign"), count(lambda x: x["kind"] == 1).alias("n_access"),
        count(lambda x: x["kind"] == 2).alias("n_hex"), F.sha2(_print(base), 256).alias("base_sha256"), _print(F.col("spans")).alias("spans"),
        count(lambda x: x["class"] == "live").alias("n_live"), count(lambda x: x["class"] == "example").alias("n_example"))


def redact(docs: DataFrame, text_col: str = "text", owner_col: str = "source", mark: str = "[SECRET]") -> DataFrame:
    """Rows of ``docs`` with ``mark`` in place of each live or shared candidate; widely copied examples stay as they are.
    Overlapping spans become one mark. Rows without such spans are unchanged, null texts too. All columns stay, one named
    ``spans`` too."""
    named = {c: f"column_{i}" for i, c in enumerate(docs.columns)}
    plain = docs.select(*[F.col(f"`{c}`").alias(k) for c, k in named.items()])
    found = scan_secrets(plain, named["doc_id"], named[text_col], named[owner_col], named["doc_id"], keep=plain.columns)
    text = F.col(named[text_col])
    bad = F.filter("spans", lambda x: x["class"] != "example")

    def step(acc: Column, x: Column) -> Column:
        fresh = x["start"] >= acc["at"]
        gap = F.substring(text, acc["at"] + 1, F.greatest(x["start"] - acc["at"], F.lit(0)))
        return F.struct(F.greatest(acc["at"], x["end"]).alias("at"),
                        F.when(fresh, F.concat(acc["out"], gap, F.lit(mark))).otherwise(acc["out"]).alias("out"))

    clean = F.aggregate(bad, F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step,
                        lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text))))
    found = found.withColumn(named[text_col], F.when(F.size(bad) > 0, clean).otherwise(text))
    return found.select(*[F.col(k).alias(c) for c, k in named.items()])


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: all documents, with live-looking secrets masked."""
    return redact(docs).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)
