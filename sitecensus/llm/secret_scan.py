"""Secret scans with an incremental blob ledger.

A text's address is its SHA-256, whatever its path or version. The ledger is a folder of Parquet files with, for each
blob, the versions of the rules that it was scanned by and what they found. A run scans only pairs of blob and
rule version that the ledger lacks, each blob once, appends them, and joins the findings back to all rows.

Texts are hardly shuffled: a Bloom filter holds the blobs that several rows have or the ledger knows. A row that
misses it has a new blob of its own and is scanned where it is. Of the others only those that a second filter does
not rule out as the row chosen for its blob are joined, exactly, to the chosen rows.

The ledger keeps matches as (gap, length, kept), gap being the characters since the match before, because splitting a
text at a pattern gives those in one pass; positions are running sums.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field
from functools import reduce
from hashlib import sha256
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import bit_of, power_of_two, shared_dir, written
from .exact_dedup import BITS_PER_ROW, BLOCK_BITS, _slots


@dataclass(frozen=True)
class Rule:
    """Leftmost non-overlapping matches of pattern count if their group has ``least`` characters. hints: a match holds one of these."""

    kind: str
    pattern: str
    least: int = 0
    group: int = 0
    hints: list[str] = field(default_factory=list)

    @property
    def version(self) -> str:
        return sha256(repr((self.kind, self.pattern, self.least, self.group)).encode()).hexdigest()[:16]

    def hit(self, match: Column, gap: Column) -> Column:
        secret = F.regexp_extract(match, self.pattern, self.group) if self.group else match
        return F.struct(F.length(gap).alias("gap"), F.length(match).alias("len"), (F.length(secret) >= self.least).alias("kept"))


def any_case(word: str) -> str:
    """Both cases of ASCII letters, without what else a case-insensitive match may take (long s, Kelvin sign)."""
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


#: Fixed patterns. A run of a class of characters is leftmost and maximal, so its least length may stand in the pattern.
KEYWORDS = "password|passwd|secret|token|api_?key"
BASE_RULES = [
    Rule("assign", rf"""({any_case(KEYWORDS)})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6, 2),
    Rule("access", "AKIA[A-Z0-9]{16,}", hints=["AKIA"]),
    Rule("hex", "[0-9a-f]{24,}"),
]
#: Fixed public formats of further credentials.
ADDED_RULES = [
    Rule("github", "gh[oprsu]_[A-Za-z0-9]{36,}", hints=["gho_", "ghp_", "ghr_", "ghs_", "ghu_"]),
    Rule("google", "AIza[A-Za-z0-9_-]{35,}", hints=["AIza"]),
    Rule("private_key", "-----BEGIN [A-Z ]{0,32}PRIVATE KEY-----", hints=["-----BEGIN "]),
    Rule("slack", "xox[abprs]-[A-Za-z0-9-]{10,}", hints=["xox"]),
    Rule("stripe", "[rs]k_live_[A-Za-z0-9]{16,}", hints=["k_live_"]),
]
RULES = BASE_RULES + ADDED_RULES
HITS = "array<struct<gap:int,len:int,kept:boolean>>"
LEDGER = f"blob string, rules array<string>, findings array<struct<rule:string,hits:{HITS}>>"


def read_ledger(spark, path: str) -> DataFrame:
    """The ledger at path; one without rows is made if there is none."""
    spark.createDataFrame([], LEDGER).coalesce(1).write.mode("append").parquet(path)
    return spark.read.schema(LEDGER).parquet(path)


def _bits(keys: DataFrame, key: Column, max_filter_mb: int, name: str) -> tuple[DataFrame, int]:
    """(name_block, name_bits): a blocked Bloom filter of the key of each row of keys; and its number of blocks."""
    n_blocks = min(power_of_two(keys.count() * BITS_PER_ROW / BLOCK_BITS), power_of_two(max_filter_mb * 256))
    block, one, two = _slots(key, n_blocks)
    slots = keys.select(block.alias(f"{name}_block"), F.explode(F.array(one, two)).alias("bit")).distinct()
    return slots.groupBy(f"{name}_block").agg(F.bitmap_construct_agg("bit").alias(f"{name}_bits")), n_blocks


def _tested(rows: DataFrame, key: Column, bits: tuple[DataFrame, int], name: str) -> DataFrame:
    """rows with a boolean column name: the filter may hold the row's key."""
    bloom, n_blocks = bits
    block, one, two = _slots(key, n_blocks)
    hit = F.coalesce(bit_of(F.col(f"{name}_bits"), one) & bit_of(F.col(f"{name}_bits"), two), F.lit(False))
    return rows.withColumn(f"{name}_block", block).join(F.broadcast(bloom), f"{name}_block", "left").withColumn(name, hit).drop(f"{name}_block", f"{name}_bits")


def scan_blobs(texts: DataFrame, rules: list[Rule]) -> DataFrame:
    """Rows of the ledger for texts (blob, text, seen): all rules whose version is not in seen (null: none)."""
    wanted = lambda rule: ~F.array_contains(F.coalesce(F.col("seen"), F.array().cast("array<string>")), rule.version)
    matches = []
    for number, rule in enumerate(rules):
        may = wanted(rule)
        if rule.hints:
            may = may & reduce(or_, (F.col("text").contains(h) for h in rule.hints))
        matches.append(F.when(may, F.regexp_extract_all("text", F.lit(rule.pattern), F.lit(0))).alias(f"found_{number}"))
    found = texts.select("blob", "text", "seen", *matches)
    findings = []
    for number, rule in enumerate(rules):
        # the last piece has no match after it
        hits = F.filter(F.zip_with(f"found_{number}", F.split("text", rule.pattern, -1), rule.hit), lambda h: h["len"].isNotNull())
        findings.append(F.when(F.size(f"found_{number}") > 0, F.struct(F.lit(rule.version).alias("rule"), hits.cast(HITS).alias("hits"))))
    scanned = F.array_compact(F.array(*(F.when(wanted(r), F.lit(r.version)) for r in rules)))
    kept = F.filter(F.array_compact(F.array(*findings)), lambda f: F.exists(f["hits"], lambda h: h["kept"]))
    return found.select("blob", scanned.alias("rules"), kept.alias("findings"))


def extend_ledger(versions: DataFrame, docs: DataFrame, ledger_path: str, rules: list[Rule], max_filter_mb: int = 128) -> None:
    """Scan what the ledger lacks of docs (doc_id, text, blob) and append it. versions: doc_id and blob of all rows."""
    spark = docs.sparkSession
    known = read_ledger(spark, ledger_path).select("blob", F.explode("rules").alias("rule")).groupBy("blob").agg(F.collect_set("rule").alias("seen"))
    blobs = versions.groupBy("blob").agg(F.count("*").alias("n"), F.max("doc_id").alias("chosen"))
    special = written(blobs.join(known, "blob", "left").where("n > 1 or seen is not null").select("blob", "chosen", "seen"), "known-blobs")
    is_known = _bits(special, F.col("blob"), max_filter_mb, "known")
    # rows that the filter takes for known ones by mistake
    alone = _tested(versions, F.col("blob"), is_known, "known").where("known").join(special.select("blob"), "blob", "left_anti")
    missing = F.size(F.array_except(F.array(*(F.lit(r.version) for r in rules)), F.coalesce("seen", F.array().cast("array<string>")))) > 0
    chosen = special.where(missing).unionByName(alone.select("blob", F.col("doc_id").alias("chosen"), F.lit(None).cast("array<string>").alias("seen")))
    chosen = written(chosen, "chosen-blobs")
    is_chosen = _bits(chosen, F.struct("blob", "chosen"), max_filter_mb, "picked")
    tested = _tested(docs, F.col("blob"), is_known, "known")
    new = tested.where("not known").select("blob", "text", F.lit(None).cast("array<string>").alias("seen"))
    maybe = _tested(tested.where("known"), F.struct("blob", F.col("doc_id").alias("chosen")), is_chosen, "picked").where("picked").select("doc_id", "blob", "text").alias("m")
    again = maybe.join(chosen.alias("c"), (F.col("m.blob") == F.col("c.blob")) & F.col("m.doc_id").eqNullSafe(F.col("c.chosen"))).select("m.blob", "m.text", "c.seen")
    scan_blobs(new.unionByName(again), rules).write.mode("append").option("compression", "zstd").parquet(ledger_path)


def blob_spans(ledger: DataFrame, rules: list[Rule]) -> DataFrame:
    """blob, kind, rank (the rule's place), start, end (code points, end exclusive) of what the ledger has found by these rules."""
    numbered = F.array_position(F.array(*(F.lit(r.version) for r in rules)), F.col("finding.rule")).cast("int") - 1
    pairs = ledger.select("blob", F.explode("findings").alias("finding")).select("blob", numbered.alias("rank"), "finding.hits").where("rank >= 0")
    # two runs at the same time may have scanned a pair each, with equal results
    hits = pairs.dropDuplicates(["blob", "rank"]).select("blob", "rank", F.posexplode("hits").alias("at", "hit"))
    up_to = Window.partitionBy("blob", "rank").orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = hits.withColumn("end", F.sum(F.col("hit.gap") + F.col("hit.len")).over(up_to)).where("hit.kept")
    kind = F.element_at(F.array(*(F.lit(r.kind) for r in rules)), F.col("rank") + 1)
    return placed.select("blob", kind.alias("kind"), "rank", (F.col("end") - F.col("hit.len")).alias("start"), "end")


def scan_secrets(docs: DataFrame, ledger_path: str | None = None, rules: list[Rule] = RULES, base: int = len(BASE_RULES), id_col: str = "doc_id", text_col: str = "text", max_filter_mb: int = 128) -> DataFrame:
    """One row for each row of docs: doc_id, blob, n_<kind> for the first ``base`` rules, base_sha256, spans.

    spans are kind:start:end of all rules, by start, then in the order of the rules, joined by commas; base_sha256 is
    the SHA-256 of those of the first ``base`` rules. ledger_path: a folder that later runs may give again (whatever they
    scan: further versions, other tables, more rules); by default a new one in the shared folder. A lost run leaves
    the ledger as it was. Null texts are empty. Repeated rows and null ids are rows of their own. Other columns are
    not read. No rows give none.
    """
    spark = docs.sparkSession
    ledger_path = ledger_path or f"{shared_dir(spark)}/secret-ledger-{uuid.uuid4().hex}"
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), F.sha2(text, 256).alias("blob"))
    versions = written(rows.select("doc_id", "blob"), "versions")
    extend_ledger(versions, rows, ledger_path, rules, max_filter_mb)
    spans = blob_spans(spark.read.schema(LEDGER).parquet(ledger_path), rules)
    listed = lambda part: F.array_join(F.transform(part, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    counts = [F.count_if(F.col("rank") == i).alias(f"n_{r.kind}") for i, r in enumerate(rules[:base])]
    by_blob = spans.groupBy("blob").agg(*counts, F.sort_array(F.collect_list(F.struct("start", "rank", "end", "kind"))).alias("all"))
    # as a table of its own, so that the join's large partitions (one text that very many rows have) can be split
    found = written(by_blob.select("blob", *(f"n_{r.kind}" for r in rules[:base]), listed(F.filter("all", lambda s: s["rank"] < base)).alias("base"), listed(F.col("all")).alias("spans")), "blob-findings")
    zero = [F.coalesce(f"n_{r.kind}", F.lit(0).cast("long")).alias(f"n_{r.kind}") for r in rules[:base]]
    none = lambda name: F.coalesce(name, F.lit(""))
    return versions.join(found, "blob", "left").select("doc_id", "blob", *zero, F.sha2(none("base"), 256).alias("base_sha256"), none("spans").alias("spans"))
