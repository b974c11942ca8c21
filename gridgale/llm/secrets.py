"""Secret scans with corpus-wide ownership, with column functions only.

Patterns give candidates with their places. A candidate's value is known by its hash,
and the corpus says in how many repositories and at how many owners that hash stands.
A value that many owners or many repositories have is an example copied from a manual; a
value that looks live and that one owner has, or two, in a few repositories, is a
credential. Base kinds are reported in
any case, wider kinds only where their value is such a credential.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridgale.llm.common import let, written

# The base kinds in their order. The first group is the value where there is
# one; `least` is the number of characters the value must have.
BASE = {
    "assign": (
        r"""((?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+))""", 6,
    ),
    "access": (r"(AKIA[A-Z0-9]+)", 20),
    "hex": (r"([0-9a-f]{24,})", 24),
}
# Wider kinds: formats of tokens, and long opaque strings.
WIDER = {
    "vendor": (
        r"((?:gh[pousr]_[A-Za-z0-9]{36}|glpat-[A-Za-z0-9_-]{20}|xox[abprs]-[A-Za-z0-9-]{10,}"
        r"|sk_live_[A-Za-z0-9]{16,}|AIza[A-Za-z0-9_-]{35}))", 14,
    ),
    "jwt": (r"(eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,})", 30),
    "bearer": (r"((?i:bearer)\x20+([A-Za-z0-9._~+/=-]{20,}))", 20),
    "opaque": (r"([A-Za-z0-9+/_-]{32,}={0,2})", 32),
}
KINDS = [*BASE, *WIDER]
PLACEHOLDER = r"(?i)example|sample|dummy|changeme|placeholder|your|xxxx|0000000|1234567"
OWNERS = 2
REPOSITORIES = 10  # of all owners of a value together
VARIETY = 8  # different characters of a value that looks live


def found(text: Column, kind: str) -> Column:
    """All matches of one kind from left to right, as (`start`, `order`, `end`, `kind`, `value`).

    Places are in code points, the end exclusive. The pattern is tried from the end of
    the match before it, with the text between taken along, so lengths add up to places.
    """
    pattern, least = {**BASE, **WIDER}[kind]
    order = KINDS.index(kind)
    walk = F.lit(rf"\G(?s:(.*?)){pattern}")
    inner = 3 if kind in ("assign", "bearer") else 2
    steps = F.arrays_zip(
        F.regexp_extract_all(text, walk, F.lit(1)).alias("gap"),
        F.regexp_extract_all(text, walk, F.lit(2)).alias("whole"),
        F.regexp_extract_all(text, walk, F.lit(inner)).alias("value"),
    )
    none = F.array().cast("array<struct<start:bigint,order:int,end:bigint,kind:string,value:string>>")

    def placed(all_steps: Column) -> Column:
        ends = running(F.transform(all_steps, lambda s: (F.length(s["gap"]) + F.length(s["whole"])).cast("long")), lambda x, y: x + y)
        return let(ends, lambda at: F.transform(all_steps, lambda s, i: F.struct(
            (F.get(at, i) - F.length(s["whole"])).alias("start"), F.lit(order).alias("order"), F.get(at, i).alias("end"),
            F.lit(kind).alias("kind"), s["value"].alias("value"),
        )))

    kept = F.filter(let(steps, placed), lambda m: F.length(m["value"]) >= least)
    return F.when(text.rlike(pattern), kept).otherwise(none)


def running(values: Column, add) -> Column:
    """What `add` makes of all values up to each one.

    Values are cut into blocks as long as there are blocks: one looks back over its own block and adds what all blocks
    before it come to. So n values take n times the root of n short steps, and no list is built up one by one.
    """
    zero = F.lit(0).cast("long")

    def over(part: Column) -> Column:
        return F.aggregate(part, zero, add)

    def in_blocks(a: Column, size: Column) -> Column:
        whole = F.transform(F.sequence(F.lit(0), F.call_function("div", F.size(a) - 1, size).cast("int")), lambda k: over(F.slice(a, k * size + 1, size)))
        before = let(whole, lambda w: F.transform(w, lambda _, k: over(F.slice(w, F.lit(1), k))))
        return let(before, lambda earlier: F.transform(
            a, lambda _, i: add(F.get(earlier, F.call_function("div", i, size).cast("int")), over(F.slice(a, i - i % size + 1, i % size + 1)))
        ))

    return let(values, lambda a: F.when(F.size(a) == 0, a).otherwise(
        let(F.ceil(F.sqrt(F.size(a))).cast("int"), lambda size: in_blocks(a, size))
    ))


def outside(wide: Column, base: Column) -> Column:
    """The wide matches that lie in no base match: the base matches that begin before or with them end earlier."""
    def beyond(entries: Column) -> Column:
        ends = F.transform(entries, lambda e: F.when(e["order"] < len(BASE), e["end"]).otherwise(F.lit(0).cast("long")))
        return let(
            running(ends, lambda x, y: F.greatest(x, y)),
            lambda most: F.filter(entries, lambda e, i: (e["order"] >= len(BASE)) & (F.get(most, i) < e["end"])),
        )

    return F.when((F.size(wide) == 0) | (F.size(base) == 0), wide).otherwise(let(F.array_sort(F.concat(base, wide)), beyond))


def joined(spans: Column) -> Column:
    """`kind:start:end` by start, then kind, then end, with commas between."""
    return F.array_join(
        F.transform(F.array_sort(spans), lambda m: F.concat_ws(":", m["kind"], m["start"].cast("string"), m["end"].cast("string"))), ","
    )


def ownership(candidates: DataFrame) -> DataFrame:
    """`hash`, `owners`, `repositories` from (`hash`, `owner`, `repository`).

    Three levels, each combined before its shuffle: a hash may fill any share of the rows.
    Null owners are one owner, and a null repository is one repository of its owner.
    """
    pairs = candidates.groupBy("hash", "owner", "repository").agg(F.lit(1).alias("one"))
    per_owner = pairs.groupBy("hash", "owner").agg(F.count("*").alias("repositories"))
    return per_owner.groupBy("hash").agg(F.count("*").alias("owners"), F.sum("repositories").alias("repositories"))


def scan_secrets(
    docs: DataFrame, carry: list[str] | None = None, text: str = "text", owner: str = "source",
    repository: str = "doc_id", most_owners: int = OWNERS, most_repositories: int = REPOSITORIES,
) -> DataFrame:
    """`row` (the columns `carry`, by default all) with `base`, all base matches, and `added`, the
    wider ones taken for credentials; both arrays of (`start`, `order`, `end`, `kind`, `value`),
    and `n_credentials`, how many matches of any kind are credentials: their value looks live, and
    it has at most `most_owners` owners and stands in at most `most_repositories` repositories.

    A wider match inside a base one is not added. A null or empty text has no matches.
    Repeated rows are scanned each, and count once in the ownership. Null owners and
    repositories count as one each. An empty table stays empty. Texts are read once and
    never shuffled; matches are written to the shared folder.
    """
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    base = F.concat(*[found(F.col("_t"), k) for k in BASE])
    wide = F.concat(*[found(F.col("_t"), k) for k in WIDER])
    scanned = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in (carry or docs.columns)]).alias("row"),
        F.col(f"`{owner}`").cast("string").alias("owner"), F.col(f"`{repository}`").cast("string").alias("repository"),
        body.alias("_t"),
    ).select("row", "owner", "repository", base.alias("base"), wide.alias("wide"))
    scanned = written(
        scanned.select(
            "row", "owner", "repository", "base", outside(F.col("wide"), F.col("base")).alias("wide"), F.monotonically_increasing_id().alias("id")
        ),
        "secrets-scanned",
    )
    candidates = scanned.select(
        "id", "owner", "repository", F.explode(F.concat("base", "wide")).alias("match")
    ).withColumn("hash", F.sha2(F.col("match.value"), 256))
    value = F.col("match.value")
    live = (F.size(F.array_distinct(F.split(value, ""))) >= VARIETY) & ~value.rlike(PLACEHOLDER)
    few = (F.col("owners") <= most_owners) & (F.col("repositories") <= most_repositories)
    credentials = (
        candidates.where(live).join(ownership(candidates).where(few), "hash")
        .groupBy("id").agg(F.collect_list("match").alias("matches"))
    )
    none = F.array().cast(scanned.schema["wide"].dataType)
    given = F.coalesce("matches", none)
    return scanned.join(credentials, "id", "left").select(
        "row", "base", F.filter(given, lambda m: m["order"] >= len(BASE)).alias("added"), F.size(given).alias("n_credentials")
    )
