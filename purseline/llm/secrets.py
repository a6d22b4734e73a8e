"""Secret scan with corpus-wide ownership: who else holds the same candidate?

Built-in functions only. Candidates are found in whole texts; the hash of each is counted by
the distinct owners and repositories that hold it. A value copied to several owners, or to many
repositories whosever they are, is an example; a value that one owner has in few repositories
and that looks random is taken for a live credential.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from purseline.staging import stage

# Kinds in the order of the contract, patterns and least lengths. Matches of the
# last three are whole runs, so a least length in the pattern changes no other match.
KINDS = {
    "assign": r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": r"AKIA[A-Z0-9]{16,}",
    "hex": r"(?<![0-9a-f])[0-9a-f]{24,}",
    "opaque": r"(?<![A-Za-z0-9_-])[A-Za-z0-9_-]{20,}",
}
BASE = ("assign", "access", "hex")
LEAST_VALUE = 6

#: Owners, or repositories of all owners, from which on a value counts as a widely copied example.
SHARED_OWNERS = 3
SHARED_REPOSITORIES = 5
#: Repositories in which one owner may use a live credential.
LIVE_REPOSITORIES = 2
#: Different characters that a live-looking value has at least.
LEAST_VARIETY = 8


def _matches(text: Column, pattern: str) -> Column:
    """Per match, leftmost first, the code points since the match before, and its text."""
    between = F.split(text, pattern, -1)
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.transform(between, lambda x: F.length(x))
    zipped = F.zip_with(F.slice(gaps, 1, F.size(gaps) - 1), found, lambda g, v: F.struct(g.alias("gap"), v.alias("found")))
    return F.when(F.size(between) > 1, zipped).otherwise(F.array())


def _value(kind: Column, found: Column) -> Column:
    """What is secret in a match: the assigned value, else all of it.

    No name of an assignment holds ``:`` or ``=``, so the first of them ends it.
    """
    return F.when(kind == "assign", F.regexp_replace(found, r"""^[^:=]*[:=]\x20*["']?""", "")).otherwise(found)


def candidates(docs: DataFrame, text: str, id: str, owner: Column, repository: Column) -> tuple[DataFrame, DataFrame]:
    """Documents by row number, and their candidates with places in code points."""
    body = F.coalesce(F.col(text), F.lit(""))
    found = stage(
        docs.select(
            F.monotonically_increasing_id().alias("row"),
            F.col(id).alias("id"),
            owner.alias("owner"),
            repository.alias("repository"),
            *[_matches(body, pattern).alias(kind) for kind, pattern in KINDS.items()],
        ),
        "secret-matches",
    )
    lists = F.array(*[F.struct(F.lit(i).alias("rank"), F.lit(k).alias("kind"), F.col(k).alias("all")) for i, k in enumerate(KINDS)])
    some = found.where(" or ".join(f"size({kind}) > 0" for kind in KINDS))
    each = some.select("row", "owner", "repository", F.explode(lists).alias("x")).where("size(x.all) > 0")
    each = each.select("row", "owner", "repository", "x.rank", "x.kind", F.posexplode("x.all").alias("n", "m"))
    upto = Window.partitionBy("row", "rank").orderBy("n")
    end = F.sum(F.col("m.gap") + F.length("m.found")).over(upto).cast("long")
    value = _value(F.col("kind"), F.col("m.found"))
    placed = each.select(
        "row",
        "owner",
        "repository",
        "rank",
        "kind",
        (end - F.length("m.found")).alias("start"),
        end.alias("end"),
        value.alias("value"),
    )
    mixed = F.col("value").rlike("[0-9]") & F.col("value").rlike("[A-Za-z]")
    passing = F.when(F.col("kind") == "assign", F.length("value") >= LEAST_VALUE).when(F.col("kind") == "opaque", mixed)
    return found.select("row", "id"), placed.where(F.coalesce(passing, F.lit(True)))


def ownership(found: DataFrame) -> DataFrame:
    """Per ``value_sha256``: ``n_owners``, ``n_repositories``, ``n_places`` and a ``verdict``.

    ``shared``: held by at least ``SHARED_OWNERS`` owners or ``SHARED_REPOSITORIES``
    repositories. ``live``: one owner's, in at most ``LIVE_REPOSITORIES``, and varied enough to
    be random. ``unclear``: the rest. A repository belongs to an owner, so one of the same name
    of another owner is another. NULL is an owner, and a repository, of its own. Every sum is
    combined map side first, so a value on a third of all rows is a few rows per task.
    """
    named = found.withColumn("value_sha256", F.sha2("value", 256))
    variety = F.size(F.array_distinct(F.split("value", "")))
    uses = named.groupBy("value_sha256", "owner", "repository").agg(
        F.count("*").alias("n"), F.max(variety).alias("variety")
    )
    owners = uses.groupBy("value_sha256", "owner").agg(
        F.count("*").alias("repositories"), F.sum("n").alias("n"), F.max("variety").alias("variety")
    )
    values = owners.groupBy("value_sha256").agg(
        F.count("*").alias("n_owners"),
        F.sum("repositories").alias("n_repositories"),
        F.sum("n").alias("n_places"),
        F.max("variety").alias("variety"),
    )
    verdict = (
        F.when((F.col("n_owners") >= SHARED_OWNERS) | (F.col("n_repositories") >= SHARED_REPOSITORIES), "shared")
        .when(
            (F.col("n_owners") == 1)
            & (F.col("n_repositories") <= LIVE_REPOSITORIES)
            & (F.col("variety") >= LEAST_VARIETY),
            "live",
        )
        .otherwise("unclear")
    )
    return values.withColumn("verdict", verdict).drop("variety")


def find_secrets(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    owner: str | Column = "source",
    repository: str | Column = "source",
) -> DataFrame:
    """Per input row ``id`` and ``secrets``, its spans by start and kind with their verdicts.

    Base spans are always there. An ``opaque`` span is there where its value is live, and no
    base span of the document covers it. NULL texts are empty. Rows that repeat count as
    places of their own. An empty table gives an empty result.
    """
    owner = F.col(owner) if isinstance(owner, str) else owner
    repository = F.col(repository) if isinstance(repository, str) else repository
    rows, found = candidates(docs, text, id, owner, repository)
    found = stage(found, "secret-candidates")
    verdicts = ownership(found)
    joined = found.withColumn("of", F.sha2("value", 256)).join(verdicts, F.col("of") == F.col("value_sha256"))
    span = F.struct("start", "rank", "end", "kind", "verdict", "n_owners", "n_repositories", "value_sha256")
    spans = joined.groupBy(F.col("row").alias("at")).agg(F.array_sort(F.collect_list(span)).alias("all"))
    base = F.filter("all", lambda s: s["kind"] != "opaque")
    # Base spans come in order; those of one kind do not overlap, so a look at each is enough.
    added = F.filter(
        "all",
        lambda s: (s["kind"] == "opaque")
        & (s["verdict"] == "live")
        & ~F.exists(F.col("base"), lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])),
    )
    chosen = spans.withColumn("base", base).select(
        "at", F.array_sort(F.concat("base", added)).alias("secrets")
    )
    none = F.array().cast(chosen.schema["secrets"].dataType)
    out = rows.join(chosen, F.col("row") == F.col("at"), "left")
    return out.select(F.col("id").alias(id), F.coalesce("secrets", none).alias("secrets"))


def secrets_report(docs: DataFrame) -> DataFrame:
    """The columns of the contract, then how many spans are live and how many are examples.

    A source is an owner, and its texts in one language are a repository.
    """
    found = find_secrets(docs, repository=F.concat_ws("/", "source", "lang"))

    def count(kind: str) -> Column:
        return F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long")

    def written(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    base = F.filter("secrets", lambda s: s["kind"] != "opaque")
    return found.select(
        "doc_id",
        *[count(kind).alias(f"n_{kind}") for kind in BASE],
        F.sha2(written(base), 256).alias("base_sha256"),
        written(F.col("secrets")).alias("spans"),
        F.size(F.filter("secrets", lambda s: s["verdict"] == "live")).cast("long").alias("n_live"),
        F.size(F.filter("secrets", lambda s: s["verdict"] == "shared")).cast("long").alias("n_shared"),
    )
