"""Full-text candidates by an inverted index, and the decision over ranked hits."""

from __future__ import annotations

from collections import namedtuple
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from folio.functions import similarity
from folio.sources import staging

HITS = 210


def index(master: DataFrame) -> DataFrame:
    """``token, id, tf`` of ``id, document``; written as a table it is the stored index.

    Counts of documents are taken at query time.
    """
    words = master.select("id", F.explode(F.split(F.lower(F.coalesce("document", F.lit(""))), r"\s+")).alias("token")).filter("token <> ''")
    return words.groupBy("token", "id").agg(F.count("*").alias("tf"))


#: Stands in a delta for a document without a word, so that it replaces the older one too.
_EMPTY = ""


def store_index(master: DataFrame, path: str, delta: bool = False, version: int | None = None) -> int:
    """Writes the postings, or appends those of a delta under the next version; returns the version."""
    if version is None:
        version = 0 if not delta else (master.sparkSession.read.parquet(path).agg(F.max("version")).first()[0] or 0) + 1
    marks = master.select(F.lit(_EMPTY).alias("token"), "id", F.lit(0).cast("long").alias("tf")).distinct()
    index(master).unionByName(marks).withColumn("version", F.lit(version)).write.mode("append" if delta else "overwrite").parquet(path)
    return version


def open_index(spark: SparkSession, path: str) -> DataFrame:
    """Stored postings of the last version of each document: a delta's document replaces the older one whole."""
    stored = spark.read.parquet(path)
    last = stored.filter(F.col("token") == _EMPTY).groupBy("id").agg(F.max("version").alias("version"))
    return stored.filter(F.col("token") != _EMPTY).join(last, ["id", "version"]).groupBy("token", "id").agg(F.max("tf").alias("tf"))


def weights(postings: DataFrame, n_docs: int) -> DataFrame:
    """Inverse document frequency of each token: 1 + ln(n / (df + 1))."""
    return postings.groupBy("token").agg((1.0 + F.log(F.lit(float(n_docs)) / (F.count("*") + 1.0))).alias("idf"))


#: Documents of a block; times the hits asked for that are scored before blocks are skipped; bytes of the texts of a part.
BLOCK, SURE, PART_BYTES = 32, 4, 4 << 20


@dataclass
class BlockIndex:
    """Postings in blocks of ``BLOCK`` documents of about one length.

    ``lists`` are ``block, token, n, most, hits``: how many postings a token has in a block, its largest
    frequency there, and the postings themselves, ``id, tf``.  Each file is sorted by block.
    """

    lists: DataFrame
    n_docs: int


def block_index(master: DataFrame) -> BlockIndex:
    """The index of ``id, document`` for searches that skip blocks; its table goes to the shared folder.

    Texts are dealt to parts of about ``PART_BYTES``, and there cut into blocks from the longest to the shortest;
    all that follows is done where a part lies, so nothing but the texts is shuffled.
    """
    text = F.lower(F.coalesce("document", F.lit("")))
    n_docs, size = master.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("document")), F.lit(0))).first()
    parts = max(master.sparkSession.sparkContext.defaultParallelism, -(-size // PART_BYTES))
    dealt = master.select("id", "document", F.pmod(F.xxhash64("id"), F.lit(parts)).alias("part")).repartitionByRange(parts, "part")
    place = F.row_number().over(Window.partitionBy("part").orderBy(F.desc(F.length(text)), "id")) - 1
    # the first blocks of all parts have the lowest numbers, so files and row groups can be left out by their bounds
    blocks = dealt.select("part", "id", text.alias("text"), (F.floor(place / BLOCK) * parts + F.col("part")).alias("block"))
    each = blocks.select("part", "block", "id", F.explode(F.split("text", r"\s+")).alias("token")).filter("token <> ''")
    counted = each.groupBy("part", "block", "token", "id").agg(F.count("*").alias("tf"))
    lists = counted.groupBy("part", "block", "token").agg(F.count("*").alias("n"), F.max("tf").alias("most"), F.collect_list(F.struct("id", "tf")).alias("hits"))
    return BlockIndex(staging.materialise(lists.drop("part").sortWithinPartitions("block", "token")), n_docs)


def query_tokens(inputs: DataFrame, names: int = 2, boost: float = 2.0) -> DataFrame:
    """``q_id, token, prefix, boost`` of ``q_id, query``: the first tokens are prefixes and count double.

    Prefix tokens lose their dots; those of one character or with a leading digit are left
    out.  Where the second token is one of these (or missing), all tokens are searched as
    they are.  A token counts once for each time it stands in the query.
    """
    words = F.split(F.lower("query"), " ")
    clean = lambda raw: F.replace(raw, F.lit("."), F.lit(""))
    good = lambda raw: F.coalesce((F.length(clean(raw)) > 1) & ~clean(raw).rlike("^[0-9]"), F.lit(False))
    at = inputs.select("q_id", good(F.get(words, F.lit(1))).alias("rewritten"), F.posexplode(words).alias("pos", "raw")).filter("raw <> ''")
    head = F.col("rewritten") & (F.col("pos") < names)
    tokens = at.select("q_id", F.when(head, clean(F.col("raw"))).otherwise(F.col("raw")).alias("token"), head.alias("prefix"), F.when(head, boost).otherwise(1.0).alias("boost"), (good(F.col("raw")) | ~head).alias("ok"))
    return tokens.filter("ok").drop("ok")


def _bags(tokens: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``q_id, bag_id`` and, for each bag of tokens, its parts ``bag_id, n, pos, token, prefix, boost``.

    Queries with the same tokens are one bag, so they are searched once.
    """
    each = F.array_sort(F.collect_list(F.struct("token", "prefix", "boost")))
    wanted = tokens.groupBy("q_id").agg(each.alias("bag")).withColumn("bag_id", F.md5(F.to_json("bag")))
    bags = wanted.groupBy("bag_id").agg(F.first("bag").alias("bag"))
    return wanted.select("q_id", "bag_id"), bags.select("bag_id", F.size("bag").alias("n"), F.posexplode("bag").alias("pos", "t")).select("bag_id", "n", "pos", "t.*")


def _meant(parts: DataFrame, idf: DataFrame) -> DataFrame:
    """``asked, prefix, token, idf``: the tokens of the vocabulary that those asked for stand for.

    Prefixes are matched by their first two characters as a join key and a test of the
    rest, so no cross join is needed.
    """
    asked = parts.select("token", "prefix").distinct()
    plain = asked.filter("NOT prefix").join(idf, "token").select(F.col("token").alias("asked"), "prefix", "token", "idf")
    heads = asked.filter("prefix").select(F.col("token").alias("asked"), "prefix", F.substring("token", 1, 2).alias("start"))
    begun = heads.join(idf.withColumn("start", F.substring("token", 1, 2)), "start").filter(F.startswith("token", "asked")).select("asked", "prefix", "token", "idf")
    return plain.unionByName(begun)


#: Binary places of the two whole numbers that a term is cut into.
_HIGH, _LOW = 26, 27


def _exact_sum(value: Column, times: Column | None = None) -> Column:
    """The sum of ``times * value``, the same in any order: whole multiples of 2^-53 are summed and rounded once.

    Sums of doubles differ by their order, so documents of one score would part at a rounded place.
    """
    scaled = value.cast("double") * F.lit(float(1 << _HIGH))
    high = F.floor(scaled)
    low = F.floor((scaled - high) * F.lit(float(1 << _LOW)))
    total = lambda c: F.sum(c if times is None else c * times).cast("double")
    return total(high) / F.lit(float(1 << _HIGH)) + total(low) / F.lit(float(1 << _HIGH + _LOW))


def _raised(score: Column, held: Column, n: Column, coverage: float | None) -> Column:
    """A score raised by the share of the query's tokens that a document holds."""
    if coverage is None:
        return score
    return F.when(n > 1, (score + (held - 1) / F.pow(n - F.lit(coverage), 2)) * (n - 1) / n).otherwise(score)


def _ranked(scored: DataFrame, k: int, bag: str = "bag_id") -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(bag).orderBy(F.desc(F.round("score", 9)), "id"))
    return scored.select(bag, "id", "score").withColumn("rank", rank).filter(F.col("rank") <= k)


def top_hits(postings: DataFrame, tokens: DataFrame, n_docs: int, k: int = HITS, coverage: float | None = None) -> DataFrame:
    """``q_id, id, score, rank``: sums of tf * idf * boost, the k best of each query, ties by id.

    All postings of the tokens asked for are read; a frequent token is looked up once for
    all queries.  With ``coverage`` (0 to 1) a score is raised by the share of the
    query's tokens that a document holds, as short queries are ranked by engines whose
    terms are joined by "or": (score + (held - 1) / (tokens - coverage)^2) * (tokens - 1) / tokens.
    """
    wanted, parts = _bags(tokens)
    met = _meant(parts, weights(postings, n_docs)).join(postings, "token").groupBy("asked", "prefix", "id").agg(_exact_sum(F.col("idf"), F.col("tf")).alias("weight"))
    met = met.withColumnRenamed("asked", "token")
    found = parts.join(met, ["token", "prefix"]).groupBy("bag_id", "id").agg(_exact_sum(F.col("weight") * F.col("boost")).alias("score"), F.count_distinct("pos").alias("held"), F.first("n").alias("n"))
    best = _ranked(found.withColumn("score", _raised(F.col("score"), F.col("held"), F.col("n"), coverage)), k)
    return wanted.join(best, "bag_id").select("q_id", "id", "score", "rank")


@dataclass
class Search:
    """The hits, and how many postings of the tokens asked for there are and were read.

    ``bags`` are ``q_id, bag_id`` and ``best`` the hits of each bag: queries with the same tokens are one.
    """

    hits: DataFrame
    asked: int
    read: int
    bags: DataFrame
    best: DataFrame

    def beside(self, master: DataFrame, rows: DataFrame) -> DataFrame:
        """The hits with the columns of their documents (``id``) and of their queries (``q_id``).

        Documents are put to the hits of distinct queries, before these are multiplied by the queries
        that ask for the same; the queries are dealt evenly to tasks, as each has many hits.
        """
        best = staging.checked_broadcast(staging.materialise(self.best), F.lit(100)).join(master, "id")
        best = staging.materialise(best)
        few = staging.checked_broadcast(best, F.lit(50) + F.octet_length(F.to_json(F.struct(*best.columns))))
        tasks = 4 * best.sparkSession.sparkContext.defaultParallelism
        asked = self.bags.join(rows, "q_id").repartition(tasks, "q_id")
        return asked.join(few if few is not best else best.hint("merge"), "bag_id").drop("bag_id")


def best_hits(index: BlockIndex, tokens: DataFrame, k: int = HITS, coverage: float | None = None) -> Search:
    """The rows of ``top_hits``, worked out without the blocks that cannot hold any of them.

    The largest contributions of a query's tokens in a block bound all scores in it.  The
    blocks of the highest bounds that hold ``SURE`` times k documents are scored first; the k-th best score found is
    the floor.  Of the other blocks only those whose bound reaches it are read and scored.
    Bounds and scores are summed where the blocks lie: a row for a bag and a block, or a bag and a document, is what is shuffled.
    """
    wanted, parts = _bags(tokens)
    parts = staging.materialise(parts)
    bags = staging.materialise(parts.select("bag_id").distinct().withColumn("bag", F.monotonically_increasing_id()))
    prefixes, last = parts.agg(F.count_if("prefix"), F.coalesce(F.max("pos"), F.lit(0))).first()
    asked = staging.checked_broadcast(parts.select("token").distinct(), F.lit(50) + F.octet_length("token"))
    known = index.lists.select("token", "n") if prefixes else index.lists.select("token", "n").join(asked, "token", "left_semi")
    spread = known.groupBy("token").agg(F.sum("n").alias("df"))
    idf = spread.select("token", (1.0 + F.log(F.lit(float(index.n_docs)) / (F.col("df") + 1.0))).alias("idf"))
    meant = _meant(parts, idf).withColumnRenamed("token", "meant").withColumnRenamed("asked", "token")
    each = parts.join(meant, ["token", "prefix"]).join(bags, "bag_id").select("bag", F.col("n").alias("size"), "pos", F.col("meant").alias("token"), (F.col("boost") * F.col("idf")).alias("heft"))
    if not prefixes:  # a token that stands in a query several times is looked up once
        each = each.groupBy("bag", "size", "token", "heft").agg(F.count("*").alias("times"))
    else:
        each = each.withColumn("times", F.lit(1).cast("long"))
    held = _positions(last) if prefixes else F.sum("times")
    each = staging.checked_broadcast(staging.materialise(each), F.lit(100) + F.octet_length("token"))
    near = index.lists.select("block", "token", F.col("n").alias("postings"), "most").join(each, "token")
    blocks = near.groupBy("bag", "block").agg(F.sum(F.col("heft") * F.col("most") * F.col("times")).alias("all"), held.alias("held"), F.max("postings").alias("documents"), F.sum(F.col("postings") * F.col("times")).alias("postings"), F.first("size").alias("size"))
    blocks = blocks.select("bag", "block", _raised(F.col("all"), F.col("held"), F.col("size"), coverage).alias("bound"), "documents", "postings")
    # the blocks that hold several times k documents for sure, from the highest bound on: the k-th best of them is a high floor
    so_far = F.sum("documents").over(Window.partitionBy("bag").orderBy(F.desc("bound"), "block").rowsBetween(Window.unboundedPreceding, -1))
    blocks = staging.materialise(blocks.withColumn("first", F.coalesce(so_far, F.lit(0)) < SURE * k).drop("documents"))
    at_once = blocks.filter("first")
    score = lambda some: staging.materialise(_scores(index, each, some, held, coverage))
    found = score(at_once)
    floor = _ranked(found, k, "bag").filter(F.col("rank") == k).select("bag", F.col("score").alias("floor"))
    # bounds are sums of doubles, which differ a little by their order
    later = staging.materialise(blocks.filter("NOT first").join(floor, "bag", "left").filter(F.col("bound") >= F.coalesce("floor", F.lit(0.0)) - 1e-6).select("bag", "block", "postings"))
    best = _ranked(found.unionAll(score(later)), k, "bag").join(bags, "bag").select("bag_id", "id", "score", "rank")
    count = lambda some: some.agg(F.sum("postings")).first()[0] or 0
    return Search(wanted.join(best, "bag_id").select("q_id", "id", "score", "rank"), count(blocks), count(at_once) + count(later), wanted, best)


#: Positions of a word of bits.
_BITS = 62


def _positions(last: int) -> Column:
    """How many different ``pos`` (up to ``last``) a group has, as bits, so that rows of a group are one before a shuffle."""
    words = [F.when(F.floor(F.col("pos") / _BITS) == w, F.expr(f"shiftleft(1L, CAST(pos % {_BITS} AS INT))")).otherwise(F.lit(0).cast("long")) for w in range(last // _BITS + 1)]
    counts = [F.bit_count(F.bit_or(w)) for w in words]
    return sum(counts[1:], counts[0]).cast("long")


def _scores(index: BlockIndex, each: DataFrame, blocks: DataFrame, held: Column, coverage: float | None) -> DataFrame:
    """``bag, id, score`` of the documents in the blocks given for each bag."""
    low, high = blocks.agg(F.min("block"), F.max("block")).first()
    lists = index.lists.filter(F.col("block").between(low, high) if low is not None else F.lit(False)).select("block", "token", "hits")
    some = staging.checked_broadcast(blocks.select("block").distinct(), F.lit(20))
    met = lists.join(some, "block", "left_semi").join(each, "token").join(staging.checked_broadcast(blocks.select("bag", "block"), F.lit(30)), ["bag", "block"])
    met = met.select("bag", "heft", "times", "size", *(["pos"] if "pos" in each.columns else []), F.explode("hits").alias("hit"))
    found = met.groupBy("bag", F.col("hit.id").alias("id")).agg(_exact_sum(F.col("heft"), F.col("hit.tf") * F.col("times")).alias("score"), held.alias("held"), F.first("size").alias("size"))
    return found.select("bag", "id", _raised(F.col("score"), F.col("held"), F.col("size"), coverage).alias("score"))


def hit_outcome(score: Column, model: Column, dob_ratio: Column, phone_first: Column, names_and_ids: Column, no_previous: Column | None = None, whole: Column | None = None) -> dict[str, Column]:
    """What one hit decides: ``accept``, ``stop``, ``found``, ``confidence``, ``note``.

    A score of 50 or more accepts with 100.  Below it the model accepts over 0.89 if the
    birth dates are alike (over 66), then agreeing phone and first name, then the rule on
    names and ids; their confidence is the score / 5.5 in percent, 99 if the model is
    under 0.57.  Else the hit says No, with that confidence where neither side has a
    previous name (``no_previous``) and score / 13.5 in percent where one has.  A hit whose
    document lacks fields (not ``whole``) says No with 0 and ends the search.
    """
    no_previous = F.lit(False) if no_previous is None else no_previous
    whole = F.lit(True) if whole is None else whole
    strong = score >= 50
    by_model = (model > 0.89) & (dob_ratio > 66)
    sure = F.when(model < 0.57, 99).otherwise(F.least(F.lit(100), (score / 5.5 * 100).cast("int")))
    accept = whole & (strong | by_model | phone_first | names_and_ids)
    confidence = F.when(~whole, 0).when(strong | by_model, 100).when(phone_first | names_and_ids | no_previous, sure).otherwise((score / 13.5 * 100).cast("int"))
    note = F.when(~whole, "Column mismatched").otherwise("")
    return {"accept": accept, "stop": accept | ~whole, "found": F.when(accept, "Yes").otherwise("No"), "confidence": confidence, "note": note}


def _by_equality(x: Callable[[str], Column], y: Callable[[str], Column]) -> tuple[Column, Column]:
    """Whether no side has a previous name, and whether names and ids agree."""
    none = lambda c: c.isin("", "nan")
    same = lambda f: x(f) == y(f)
    no_previous = none(x("prev")) & none(y("prev"))
    family = same("last") | (~no_previous & same("prev"))
    return no_previous, same("first") & family & (same("dob") | same("phone"))


def field_outcome(score: Column, model: Column, row: str = "row", master: str = "master", whole: Column | None = None) -> dict[str, Column]:
    """``hit_outcome`` from the fields of the row and of the hit: structs ``first, last, prev, dob, phone`` of normalised texts.

    Phone and first name agree by the matching-blocks ratio (90 or more), birth dates are
    alike over 66; names and ids are compared by equality, the previous name only where
    one side has one (the text ``nan`` or nothing is none).
    """
    x, y = (lambda f: F.coalesce(F.col(f"{row}.{f}"), F.lit(""))), (lambda f: F.coalesce(F.col(f"{master}.{f}"), F.lit("")))
    ratio = lambda f: similarity.sequence_ratio(x(f), y(f))
    no_previous, names_and_ids = _by_equality(x, y)
    phone_first = (ratio("phone") >= 90) & (ratio("first") >= 90)
    return hit_outcome(score, model, ratio("dob"), phone_first, names_and_ids, no_previous, whole)


#: Fields of the two sides that ``first_accepted`` compares.
FIELDS = ("first", "last", "prev", "dob", "phone")
#: Those of them that may need a ratio, and ratios that a task remembers.
RATIOS, REMEMBERED = ("dob", "phone", "first"), 1 << 16
DECIDED = "id long, found string, confidence int, hits_read int, ratios int"


def first_accepted(hits: DataFrame, queries: DataFrame, row: str = "row", master: str = "master", model: str = "model_score") -> DataFrame:
    """``q_id, id, found, confidence, hits_read, ratios``: the rows of ``decide`` over ``field_outcome``, by a scan that stops.

    ``hits`` are ``q_id, id, rank, score``, the model's score and the structs of both sides.
    The hits of a query are read in the order of their rank up to the first that accepts,
    and a matching-blocks ratio is worked out only where equality and the scores leave the
    decision open: that of birth dates only for a sure model, that of first names only for
    alike phones; what equality says is worked out before, and a ratio of two texts that a task has had lately is not worked out again.  A hit whose column ``whole`` (if there is one) is false ends the search with No and 0.  ``hits_read`` and ``ratios`` say how many were.  A query's hits are one
    sorted run of a partition, so a task holds one hit at a time.
    """
    x, y = (lambda f: F.coalesce(F.col(f"{row}.{f}"), F.lit(""))), (lambda f: F.coalesce(F.col(f"{master}.{f}"), F.lit("")))
    texts = [c.alias(f"{side}_{f}") for f in RATIOS for side, c in (("x", x(f)), ("y", y(f)))]
    no_previous, named = _by_equality(x, y)
    whole = F.coalesce(F.col("whole"), F.lit(False)) if "whole" in hits.columns else F.lit(True)
    flat = hits.select("q_id", whole.alias("whole"), F.col("id").cast("long").alias("id"), "rank", F.col("score").cast("double").alias("score"), F.col(model).cast("double").alias("model"), no_previous.alias("no_previous"), named.alias("named"), *texts)
    runs = flat.repartition("q_id").sortWithinPartitions("q_id", "rank").drop("rank")
    kind = hits.schema["q_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        walk = _Walk()
        for batch in batches:
            walk.kind = batch.schema.field("q_id").type
            for hit in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                walk.step(_Hit._make(hit))
            if walk.done:
                yield walk.flush()
        walk.end()
        if walk.done:
            yield walk.flush()

    found = runs.mapInArrow(run, f"q_id {kind}, {DECIDED}")
    out = queries.select("q_id").join(found, "q_id", "left")
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return out.select("q_id", "id", F.coalesce("found", F.lit("No")).alias("found"), zero("confidence"), zero("hits_read"), zero("ratios"))


_Hit = namedtuple("_Hit", ["q_id", "whole", "id", "score", "model", "no_previous", "named", *(f"{side}_{f}" for f in RATIOS for side in "xy")])


class _Walk:
    """The hits of one query after the other, in the order of their rank."""

    def __init__(self) -> None:
        self.done: list[tuple] = []
        self.begun, self.kind, self.alike = False, pa.int64(), lru_cache(REMEMBERED)(similarity.ratio)
        self.start(None)

    def start(self, query: object) -> None:
        self.query, self.accepted, self.ended, self.last, self.read, self.ratios = query, None, False, 0, 0, 0

    def ratio(self, x: str, y: str) -> int:
        self.ratios += 1
        return self.alike(x, y)

    def end(self) -> None:
        if self.begun:
            found, confidence = ("No", self.last) if self.accepted is None else ("Yes", self.last)
            self.done.append((self.query, self.accepted, found, confidence, self.read, self.ratios))

    def step(self, hit: _Hit) -> None:
        if not self.begun or hit.q_id != self.query:
            self.end()
            self.start(hit.q_id)
            self.begun = True
        elif self.ended:
            return
        self.read += 1
        accept, self.last = self.judge(hit) if hit.whole else (False, 0)
        self.ended = accept or not hit.whole
        if accept:
            self.accepted = hit.id

    def judge(self, hit: _Hit) -> tuple[bool, int]:
        score, model = hit.score, hit.model
        if score >= 50 or (model > 0.89 and self.ratio(hit.x_dob, hit.y_dob) > 66):
            return True, 100
        sure = 99 if model < 0.57 else min(100, int(score / 5.5 * 100))
        if hit.named:
            return True, sure
        if self.ratio(hit.x_phone, hit.y_phone) >= similarity.EXACT_FROM and self.ratio(hit.x_first, hit.y_first) >= similarity.EXACT_FROM:
            return True, sure
        return False, sure if hit.no_previous else int(score / 13.5 * 100)

    def flush(self) -> pa.RecordBatch:
        names = ["q_id", *(c.split()[0] for c in DECIDED.split(", "))]
        kinds = [None, pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.int32()]
        columns = [pa.array([r[i] for r in self.done], kinds[i] or self.kind) for i in range(6)]
        self.done = []
        return pa.record_batch(columns, names=names)


def no_hit_error(fields: list[str], code: str) -> str:
    """The message of a row without any hit: all fields but the last."""
    return f"{code}: {', '.join(fields[:-1])}"


def decide(hits: DataFrame, queries: DataFrame) -> DataFrame:
    """The first hit of each query that accepts (or stops the search), else the last one's No; no hit at all is No with 0."""
    ends = F.col("stop") if "stop" in hits.columns else F.col("accept")
    first = F.min_by(F.struct("id", "found", "confidence"), F.when(ends, F.col("rank")))
    last = F.max_by(F.struct("id", "found", "confidence"), "rank")
    best = hits.groupBy("q_id").agg(F.coalesce(first, last).alias("b"))
    joined = queries.select("q_id").join(best, "q_id", "left")
    yes = F.col("b.found") == "Yes"
    return joined.select("q_id", F.when(yes, F.col("b.id")).alias("id"), F.coalesce("b.found", F.lit("No")).alias("found"), F.coalesce("b.confidence", F.lit(0)).alias("confidence"))
