"""Secret scans that ask who owns a candidate, with Spark expressions only.

Patterns find candidates in whole texts. A text itself never leaves its scan: what goes on are the gaps between matches, the matches' lengths
and 128-bit hashes of the values. Over the whole corpus a value is counted by the distinct repositories and owners that hold it.
One that many of them hold is an example that people copy; one that few hold and that looks random is a live credential.

Spans of the patterns ``assign``, ``access`` and ``hex`` always stay, with that verdict. Opaque strings of no known form (``token``) are
too many to report all: they become spans only if they overlap no other one and are owner-specific and live-looking.
"""

from pyspark.sql import Column, DataFrame, Window, functions as F

from stratalake.llm.common import salted_lookup
from stratalake.sources.scratch import stage

# The kinds in their order, the patterns of the candidates, and how long a value of each must be.
KINDS = ("assign", "access", "hex", "token")
BASE_KINDS = KINDS[:3]
_KEYWORDS = ("password", "passwd", "secret", "token", "api_?key")
LEAST_LENGTH = {"assign": 6, "access": 20, "hex": 24, "token": 20}
#: What says that a value stands for another one.
PLACEHOLDERS = ("example", "sample", "dummy", "placeholder", "changeme", "your", "xxxx", "1234567", "abcdef", "redacted")


def either_case(word: str) -> str:
    """A pattern for ASCII letters in either case, and for nothing else that some engine would fold to them."""
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)


# A match of the first pattern that is too short still takes its place, so its length is asked afterwards. The others are whole runs
# of their characters: shorter runs can be left out by the pattern. The look-behind keeps long runs from being tried at each place.
PATTERNS = {
    "assign": f"({'|'.join(map(either_case, _KEYWORDS))})" + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": r"AKIA[A-Z0-9]{16,}",
    "hex": r"(?<![0-9a-f])[0-9a-f]{24,}",
    "token": r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}",
}


_PIECE = "kind_no:int,gap:int,length:int,long_enough:boolean,live:boolean,value:binary"


def _value(kind: str, match: Column) -> Column:
    return F.regexp_extract(match, PATTERNS[kind], 2) if kind == "assign" else match


def live_looking(value: Column, characters: int = 10) -> Column:
    """Letters and digits, many different characters, and nothing that marks a placeholder."""
    plain = F.lower(value)
    marked = F.lit(False)
    for word in PLACEHOLDERS:
        marked = marked | plain.contains(word)
    mixed = value.rlike("[0-9]") & value.rlike("[A-Za-z]")
    return mixed & (F.size(F.array_distinct(F.split(value, ""))) >= characters) & ~marked


def find_secrets(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    repository_column: str = "doc_id",
    owner_column: str = "source",
    copied_owners: int = 3,
    copied_repositories: int = 20,
) -> DataFrame:
    """One row per document: ``doc_id`` and ``spans``, an array of structs, by start, then kind as in ``KINDS``.

    A span has ``start``, ``kind_no``, ``kind``, ``end`` (code points from 0, end exclusive), ``n_repositories`` and ``n_owners`` (that hold its
    value in the whole corpus; repositories count per owner) and ``verdict``: ``copied`` if at least ``copied_owners`` owners or
    ``copied_repositories`` repositories hold it, else ``live`` if it looks so, else ``unlikely``. In ``documents`` a document is a
    repository of its source.

    A null text is empty. A null owner, and a null repository, is one of its own. Repeated rows and rows without an id each keep a
    row; copies count as one repository if their id is one. Other columns are ignored; an empty table gives no rows. A value
    that a third of all documents hold is counted inside the tasks and by owner and repository first, and its counts return to at
    most 64 parts of its documents. Windows see the candidates of one document.
    """
    text = F.coalesce(F.col(text_column), F.lit(""))
    scanned = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id_column).alias("doc_id"),
        F.coalesce(F.col(repository_column).cast("string"), F.lit("")).alias("repository"),
        F.col(repository_column).isNull().alias("no_repository"),
        F.col(owner_column).cast("string").alias("owner"),
        F.concat(*[_found_in(text, kind) for kind in KINDS]).alias("found"),
    )
    # Stored, so that a row keeps its number.
    scanned = stage(scanned, "scanned")
    candidates = stage(_placed(scanned), "candidates")
    owned = stage(ownership(candidates), "ownership")

    judged = salted_lookup(candidates, owned, "value", ["row"])
    copied = (F.col("n_owners") >= copied_owners) | (F.col("n_repositories") >= copied_repositories)
    verdict = F.when(copied, "copied").when(F.col("live"), "live").otherwise("unlikely")
    judged = judged.withColumn("verdict", verdict).filter(
        (F.col("kind_no") < len(BASE_KINDS)) | ((F.col("verdict") == "live") & ~F.col("covered"))
    )
    span = F.struct(
        "start",
        "kind_no",
        F.get(F.array(*map(F.lit, KINDS)), F.col("kind_no")).alias("kind"),
        "end",
        "n_repositories",
        "n_owners",
        "verdict",
    )
    by_row = judged.groupBy("row").agg(F.sort_array(F.collect_list(span)).alias("spans"))
    none = F.array().cast(by_row.schema["spans"].dataType)
    return scanned.select("row", "doc_id").join(by_row, "row", "left").select("doc_id", F.coalesce("spans", none).alias("spans"))


def _found_in(text: Column, kind: str) -> Column:
    """The matches of a kind in a text as an array of structs; most texts have none and are scanned once."""
    found = F.regexp_extract_all(text, F.lit(PATTERNS[kind]), F.lit(0))
    gaps = F.transform(F.split(text, PATTERNS[kind], -1), lambda gap: F.length(gap))

    def piece(pair: Column) -> Column:
        value = _value(kind, pair["match"])
        return F.struct(
            F.lit(KINDS.index(kind)).alias("kind_no"),
            pair["gap"].alias("gap"),
            F.length(pair["match"]).alias("length"),
            (F.length(value) >= LEAST_LENGTH[kind]).alias("long_enough"),
            live_looking(value).alias("live"),
            F.unhex(F.md5(value.cast("binary"))).alias("value"),
        )

    # There is one gap more than matches.
    pairs = F.arrays_zip(F.slice(gaps, F.lit(1), F.size(found)).alias("gap"), found.alias("match"))
    some = F.transform(pairs, piece)
    return F.when(text.rlike(PATTERNS[kind]), some).otherwise(F.array().cast(f"array<struct<{_PIECE}>>"))


def _placed(scanned: DataFrame) -> DataFrame:
    """A row per candidate that is long enough, with its place, and whether another kind's span overlaps it."""
    pieces = scanned.select("row", "owner", "repository", "no_repository", F.posexplode("found").alias("nth", "piece")).select(
        "row", "owner", "repository", "no_repository", "nth", "piece.*"
    )
    so_far = Window.partitionBy("row", "kind_no").orderBy("nth").rowsBetween(Window.unboundedPreceding, 0)
    ends = pieces.withColumn("end", F.sum(F.col("gap") + F.col("length")).over(so_far))
    kept = ends.filter("long_enough").withColumn("start", F.col("end") - F.col("length"))

    # Base spans that start before it or with it and reach into it, or start in it.
    is_base = F.col("kind_no") < len(BASE_KINDS)
    before = Window.partitionBy("row").orderBy("start", "kind_no").rowsBetween(Window.unboundedPreceding, 0)
    after = Window.partitionBy("row").orderBy(F.col("start").desc(), F.col("kind_no").desc()).rowsBetween(Window.unboundedPreceding, 0)
    reached = F.max(F.when(is_base, F.col("end"))).over(before)
    next_start = F.min(F.when(is_base, F.col("start"))).over(after)
    covered = F.coalesce(reached > F.col("start"), F.lit(False)) | F.coalesce(next_start < F.col("end"), F.lit(False))
    return kept.select("row", "owner", "repository", "no_repository", "kind_no", "start", "end", "live", "value", covered.alias("covered"))


def ownership(candidates: DataFrame) -> DataFrame:
    """``n_repositories`` and ``n_owners`` by ``value``. Counted in steps, so a value that all hold never meets in one task."""
    held = candidates.select("value", "owner", "repository", "no_repository").distinct()
    by_owner = held.groupBy("value", "owner").agg(F.count(F.lit(1)).alias("n"))
    return by_owner.groupBy("value").agg(F.sum("n").alias("n_repositories"), F.count(F.lit(1)).alias("n_owners"))


def count_kind(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def told(spans: Column) -> Column:
    """``kind:start:end`` of all spans, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def base_spans(spans: Column) -> Column:
    return F.filter(spans, lambda s: s["kind_no"] < len(BASE_KINDS))
