"""Fuzzy line dedup with DataFrame operations only.

Units are the lines of a text. A line is made of pieces that end behind a
white-space sign or ``PIECE`` code points; one of more than ``STRETCH`` pieces
is cut into stretches of that many, each a unit. Units are compared in lower
case, with white space made one space and none at the ends; all are compared
that have any text, whatever their length.

1. SimHash: bit i of a unit's fingerprint is set if it is set in more than
   half the hashes of its distinct words (a word that a line repeats over and
   over would else decide all bits alone). Words are rows; seven 9-bit counters share a
   long, so nine grouped sums count all 63 bits (a stretch has fewer words
   than a counter can hold).
2. Equal units become one. Distinct units join on pigeonhole blocks: the bits
   are cut into m blocks; fingerprints within ``RADIUS`` bits agree on at
   least m - RADIUS of them, so joining on every choice of that many blocks
   finds every pair. m only says how selective a key is; it grows with the
   number of units, and any m gives the same pairs. A row of a bucket holds
   every bit once: those of its choice in the key, the others beside the
   unit's length in one more number.
3. Links: within the radius, and at most a tenth of the longer unit's code
   points apart in edits; ``MOST_EDITS`` is the tenth of the longest unit.
4. Groups: connected components. Every unit is first compared with the first
   one of one of its buckets; later only units of different components are
   paired, so a dense group of n variants takes about n comparisons, not all
   its pairs, and no link between components is lost.
5. The first occurrence of a group, by document id, then text, line and
   stretch, is kept.

Documents with the same id and the same text are one document: their lines
share one fate. Null ids come after all others; null texts have no lines.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candela.llm import common

LEAST_WORDS = 1
STRETCH, PIECE = 400, 64
BITS, LANE = 63, 9
LANES = BITS // LANE
RADIUS = 3
SIMILARITY, MOST_EDITS = 0.9, STRETCH * PIECE // 10
STRIDE = 1 << 31
#: Words of the other text among which a word is looked for, besides those that wait.
AHEAD = 2
#: Low bits that hold a unit's length beside its bits: a unit has at most ``STRETCH`` pieces, and lower case makes at most three signs of one.
CHARS = 17
#: A bucket of at most so many units is compared whole as it is read; of a larger one all go on.
SMALL = 8
SIGNS = (" ", "\t", "\x0b", "\f", "\r")
WHITE, WORD = r"[\x20\t\x0B\f\r]", rf"[^\x20\t\x0B\f\r]{{{PIECE}}}"


def stretches(line: Column) -> Column:
    """The units of a line: itself, or its stretches if it is long. Put together they are the line."""
    ends = rf"(?<={WHITE})"
    # where no word is as long as a piece, all pieces end behind white space
    pieces = F.when(line.rlike(WORD), F.split(line, rf"{ends}|(?<=\G.{{{PIECE}}})")).otherwise(F.split(line, ends))

    def cut(p: Column) -> Column:
        at = F.sequence(F.lit(0), F.floor((F.size(p) - 1) / STRETCH).cast("int"))
        return F.when(F.size(p) <= STRETCH, F.array(line)).otherwise(
            F.transform(at, lambda k: F.array_join(F.slice(p, k * STRETCH + 1, F.lit(STRETCH)), ""))
        )

    # split once, not for every stretch; a short line has no more words than a counter can hold
    return F.when(is_short(line), F.array(line)).otherwise(F.element_at(F.transform(F.array(pieces), cut), 1))


def is_short(line: Column) -> Column:
    """Whether a line is one unit, told without cutting it: a piece ends behind a white-space sign or is ``PIECE`` code points."""
    rest = line
    for sign in SIGNS:
        rest = F.replace(rest, F.lit(sign), F.lit(""))
    most = F.length(line) - F.length(rest) + F.floor(F.length(line) / PIECE) + 1
    return (F.length(line) <= 2 * STRETCH) | (most <= STRETCH)


def normal(s: Column) -> Column:
    """What is compared of a unit."""
    other = reduce(or_, [F.contains(s, F.lit(x)) for x in ("  ", *SIGNS[1:])])
    return F.lower(F.trim(F.when(other, F.regexp_replace(s, f"{WHITE}+", " ")).otherwise(s)))


def units(docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    """Rows (doc_id, text_key, unit, s): the units that have text, as they are compared; unit is line * 2^31 + stretch.

    What is computed of a row stands in a step before its parts become rows,
    else it would be computed again for every part. ``_outer``: a plain
    explode first filters by the size of the array, and computes it again for that.
    """
    keyed = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.xxhash64(f"`{text}`").alias("text_key"), F.split(F.col(f"`{text}`"), "\n").alias("lines"))
    lines = keyed.select("doc_id", "text_key", F.posexplode_outer("lines").alias("line", "s"))
    parts = F.when(is_short(F.col("s")), F.array(normal(F.col("s")))).otherwise(F.transform(stretches(F.col("s")), normal))
    cut = lines.withColumn("parts", parts).select("doc_id", "text_key", "line", F.posexplode_outer("parts").alias("stretch", "s"))
    unit = (F.col("line") * F.lit(STRIDE) + F.col("stretch")).alias("unit")
    return cut.where("s != ''").select("doc_id", "text_key", unit, "s")


def fingerprinted(docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    """Rows (doc_id, text_key, unit, key, chars, fp) of all units."""
    hashes = F.array_distinct(F.transform(F.split("s", " "), lambda w: F.xxhash64(w)))
    own = units(docs, text, doc_id).select(
        "doc_id", "text_key", "unit", F.unhex(F.md5(F.col("s").cast("binary"))).alias("key"), F.length("s").alias("chars"), hashes.alias("hashes")
    )
    word = own.select("doc_id", "text_key", "unit", "key", "chars", F.explode_outer("hashes").alias("h"))
    mask = sum(1 << (LANE * k) for k in range(LANES))
    counted = word.groupBy("doc_id", "text_key", "unit", "key", "chars").agg(
        F.count("*").alias("n"),
        *[F.sum(F.shiftrightunsigned("h", j).bitwiseAND(F.lit(mask))).alias(f"l{j}") for j in range(LANE)],
    )
    fp = F.lit(0).cast("long")
    for j in range(LANE):
        fp = fp.bitwiseOR(F.shiftleft(_majority(F.col(f"l{j}"), F.col("n")), j))
    return counted.select("doc_id", "text_key", "unit", "key", "chars", fp.alias("fp"))


def _majority(counters: Column, n: Column) -> Column:
    """Seven packed counters -> a 1 in the lowest bit of each that is over half of ``n``.

    Every second counter is looked at with the room of its neighbour: what is
    added to it reaches its tenth bit exactly if it is over half of ``n``. The
    topmost has no such room and is compared by itself.
    """
    lows = sum(1 << (2 * LANE * k) for k in range(LANES // 2))
    full = (1 << LANE) - 1
    need = F.lit(1 << LANE) - F.floor(n / 2) - 1

    def over(three: Column) -> Column:
        return F.shiftright(three.bitwiseAND(F.lit(lows * full)) + need * F.lit(lows), LANE).bitwiseAND(F.lit(lows))

    top = F.when(F.shiftright(counters, LANE * (LANES - 1)) * 2 > n, F.lit(1 << (LANE * (LANES - 1)))).otherwise(F.lit(0)).cast("long")
    return over(counters).bitwiseOR(F.shiftleft(over(F.shiftright(counters, LANE)), LANE)).bitwiseOR(top)


def block_keys(fp: Column, distinct: int) -> list[Column]:
    """One key for every choice of blocks that a pair within the radius agrees on for one choice at least.

    A struct (k, rest): ``k`` is the key, the choice and its bits; ``rest`` the other bits.
    """
    m = next((m for m in range(RADIUS + 2, 9) if BITS * (m - RADIUS) / m >= max(1, distinct).bit_length() + 3), 9)
    edges = [BITS * i // m for i in range(m + 1)]
    blocks = [*zip(edges, edges[1:])]

    def packed(some: list[tuple[int, int]], low: Column, at: int) -> Column:
        """The bits of some blocks side by side, above ``low`` and its ``at`` bits."""
        for a, b in some:
            low, at = low.bitwiseOR(F.shiftleft(F.shiftrightunsigned(fp, a).bitwiseAND(F.lit((1 << (b - a)) - 1)), at)), at + b - a
        return low

    keys = []
    for t, chosen in enumerate(combinations(blocks, m - RADIUS)):
        others = [x for x in blocks if x not in chosen]
        keys.append(F.struct(packed([*chosen], F.lit(t).cast("long"), 7).alias("k"), packed(others, F.lit(0).cast("long"), 0).alias("rest")))
    return keys


def texts_of(docs: DataFrame, wanted: DataFrame, text: str, doc_id: str) -> DataFrame:
    """Rows (id, s): lower-case text of distinct units, read where each occurs first.

    A document gets the list of its wanted units and gives up these alone.
    """
    place = F.struct("id", F.floor(F.col("unit") / STRIDE).cast("int").alias("line"), (F.col("unit") % STRIDE).cast("int").alias("stretch"))
    lists = wanted.groupBy(F.col("doc_id").alias("__id"), F.col("text_key").alias("__key")).agg(F.collect_list(place).alias("places"))
    some = common.may_be_among(docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("s")), "doc_id", wanted, "doc_id")
    both = some.withColumn("own", F.xxhash64("s")).join(lists, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("own") == F.col("__key")))
    lines = both.select("places", F.split("s", "\n").alias("lines")).select(
        F.explode_outer(F.transform("places", lambda p: F.struct(p["id"].alias("id"), F.get("lines", p["line"]).alias("s"), p["stretch"].alias("stretch")))).alias("p")
    )
    cut = lines.select("p.*").withColumn("s", F.when(is_short(F.col("s")), F.col("s")).otherwise(F.get(stretches(F.col("s")), F.col("stretch"))))
    return cut.select("id", normal(F.col("s")).alias("s")).dropDuplicates(["id"])


def verified(pairs: DataFrame, distinct: DataFrame, docs: DataFrame, text: str, doc_id: str) -> tuple[DataFrame, DataFrame]:
    """The pairs (a, b) whose units are similar enough by edit distance, and the rows of ``distinct`` of all that were looked at."""
    pairs = common.stored(pairs.distinct())
    ids = common.stored(pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct())
    asked = common.stored(common.may_be_among(distinct, "id", ids, "id").join(ids, "id", "left_semi"))
    s = common.stored(texts_of(docs, asked, text, doc_id))
    both = pairs.join(s.select(F.col("id").alias("a"), F.col("s").alias("x")), "a").join(s.select(F.col("id").alias("b"), F.col("s").alias("y")), "b")
    most = F.least(F.floor(F.greatest(F.length("x"), F.length("y")) * (1 - SIMILARITY) + 1e-9), F.lit(MOST_EDITS)).cast("int")
    near = both.withColumn("__most", most).where(F.abs(F.length("x") - F.length("y")) <= F.col("__most"))
    return common.stored(near.where(_within("x", "y")).select("a", "b")), asked


def _may_link(rest: Column, other: Column) -> Column:
    """Of two rows of one bucket: within the radius, and no further apart in length than their edits may be."""
    chars, other_chars = (c.bitwiseAND(F.lit((1 << CHARS) - 1)) for c in (rest, other))
    most = F.floor(F.greatest(chars, other_chars) * (1 - SIMILARITY) + 1e-9)
    return (F.bit_count(F.shiftrightunsigned(rest.bitwiseXOR(other), CHARS)) <= RADIUS) & (F.abs(chars - other_chars) <= F.least(most, F.lit(MOST_EDITS)))


def _at_word_places(x: str, y: str) -> Column:
    """Edits that turn one text into the other word by word, each changed word anew; null if they have unlike numbers of words.

    Never less than the edit distance, and found in one pass over the texts.
    """
    a, b = F.split(x, " "), F.split(y, " ")
    each = F.zip_with(a, b, lambda v, w: F.when(v == w, 0).otherwise(F.greatest(F.length(v), F.length(w))))
    return F.when(F.size(a) == F.size(b), F.aggregate(each, F.lit(0), lambda n, m: n + m))


def _in_step(x: str, y: str) -> Column:
    """Edits of one way to turn one text into the other, found in one pass over the words: never less than the edit distance.

    Each word of ``y`` is looked for among the next few of ``x``; between two
    that are found, what ``x`` has becomes what ``y`` has, at most the longer
    of both in edits. A word counts with the space behind it.
    """

    def chars(words: Column) -> Column:
        return F.when(F.size(words) > 0, F.length(F.array_join(words, " ")) + 1).otherwise(0)

    def state(at: Column, new: Column, waiting: Column, edits: Column) -> Column:
        return F.struct(at.alias("at"), new.alias("new"), waiting.alias("waiting"), edits.alias("edits"))

    def walk(words: Column) -> Column:
        def look(s: Column, w: Column) -> Column:
            def go(k: Column) -> Column:
                left_out = chars(F.slice(words, s["at"] + 1, k - 1))
                found = state(s["at"] + k, F.lit(0), F.lit(0), s["edits"] + F.greatest(s["waiting"], left_out))
                return F.when(k > 0, found).otherwise(state(s["at"], s["new"] + 1, s["waiting"] + F.length(w) + 1, s["edits"]))

            # a lambda of its own, so that the place is looked up once
            near = F.array_position(F.slice(words, s["at"] + 1, s["new"] + AHEAD), w).cast("int")
            return F.element_at(F.transform(F.array(near), go), 1)

        def step(s: Column, w: Column) -> Column:
            next_one = (s["new"] == 0) & (F.get(words, s["at"]) == w)
            return F.when(next_one, state(s["at"] + 1, F.lit(0), F.lit(0), s["edits"])).otherwise(look(s, w))

        def total(s: Column) -> Column:
            return s["edits"] + F.greatest(s["waiting"], chars(F.slice(words, s["at"] + 1, F.size(words))))

        return F.aggregate(F.split(y, " "), state(*[F.lit(0)] * 4), step, total)

    return F.element_at(F.transform(F.array(F.split(x, " ")), walk), 1)


def _within(x: str, y: str) -> Column:
    """Whether the edit distance is at most ``__most``.

    Most pairs are told by their words; only what these bounds leave open
    needs the distance itself, whose time grows with the square of the length
    however few edits are asked for.
    """

    def told(bound: Column) -> Column:
        return F.coalesce(bound <= F.col("__most"), F.lit(False))

    exact = F.expr(f"levenshtein({x}, {y}, __most) >= 0")
    return F.when(told(_at_word_places(x, y)), True).when(told(_in_step(x, y)), True).when(told(_in_step(y, x)), True).otherwise(exact)


def groups(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per occurrence of a unit whose group has at least two.

    Columns: ``doc_id``, ``text_key`` (hash of the text, which tells apart
    documents with the same id), ``unit`` (line * 2^31 + stretch), ``line``,
    ``group_id`` and ``kept``, true for the group's first occurrence.
    """
    found = common.stored(fingerprinted(docs, text, doc_id))
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key", "unit")
    # a row written twice is one occurrence
    at = F.xxhash64("doc_id", "text_key", "unit")
    once = found.groupBy("key").agg(
        F.min(place).alias("first"), (F.min(at) != F.max(at)).alias("again"), F.min("fp").alias("fp"), F.min("chars").alias("chars")
    )
    distinct = common.stored(
        once.select(
            F.monotonically_increasing_id().alias("id"), "key", "fp", "chars", "first.doc_id", "first.text_key", "first.unit", "again"
        )
    )
    keys = F.explode(F.array(*block_keys(F.col("fp"), distinct.count())))
    bucket = Window.partitionBy("k").orderBy("id")
    whole = bucket.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ends = [f(c).over(whole).alias(f"{n}_{c}") for n, f, c in (("lead", F.first, "id"), ("lead", F.first, "rest"), ("last", F.last, "rest"))]
    # units that share a key by chance are told here and not written: pairs first, then small buckets; larger ones go on whole
    shared = (
        distinct.select("id", "chars", keys.alias("key"))
        .select("id", "key.k", F.shiftleft("key.rest", CHARS).bitwiseOR(F.col("chars").cast("long")).alias("rest"))
        .select("id", "k", "rest", F.count("*").over(whole).alias("n"), *ends)
        .where((F.col("n") > 2) | ((F.col("n") == 2) & _may_link(F.col("lead_rest"), F.col("last_rest"))))
    )
    others = [f("rest", i).over(bucket) for i in range(1, SMALL) for f in (F.lag, F.lead)]
    beside = shared.select("*", *[c.alias(f"o{i}") for i, c in enumerate(others)])
    may = reduce(or_, [F.coalesce(_may_link(F.col("rest"), F.col(f"o{i}")), F.lit(False)) for i in range(len(others))])
    buckets = common.stored(beside.where((F.col("n") > SMALL) | may).select("id", "k", "rest", "lead_id", "lead_rest"))
    stars = buckets.where((F.col("id") != F.col("lead_id")) & _may_link(F.col("rest"), F.col("lead_rest")))
    # of the first ones of all its buckets one is enough: what it does not link is compared below
    one = stars.groupBy("id").agg(F.min("lead_id").alias("a")).select("a", F.col("id").alias("b"))
    edges, asked = verified(one, distinct, docs, text, doc_id)
    first = common.stored(common.components(edges))

    named = buckets.select("id", "k", "rest").join(first.withColumnRenamed("node", "id"), "id", "left").withColumn("root", F.coalesce("root", "id"))
    a, b = (named.select("k", *[F.col(c).alias(f"{c}_{s}") for c in ("id", "rest", "root")]) for s in "ab")
    rest = a.join(b, "k").where(
        (F.col("id_a") < F.col("id_b")) & (F.col("root_a") != F.col("root_b")) & _may_link(F.col("rest_a"), F.col("rest_b"))
    )
    rest = rest.select(F.col("id_a").alias("a"), F.col("id_b").alias("b")).distinct().join(one, ["a", "b"], "left_anti")
    more, also = verified(rest, distinct, docs, text, doc_id)
    linked = common.stored(common.components(edges.unionByName(more)))

    # a unit without a link that occurs once is in no group; one that is linked was looked at above
    alone = distinct.where("again").join(linked.select(F.col("node").alias("id")), "id", "left_anti").withColumn("root", F.col("id"))
    roots = linked.withColumnRenamed("node", "id")
    rooted = common.stored(asked.unionByName(also).dropDuplicates(["id"]).join(roots, "id").unionByName(alone))
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key", "unit")
    heads = (
        rooted.groupBy("root")
        .agg(F.min(place).alias("head"), F.min("key").alias("group_id"), F.count("*").alias("n"), F.bool_or("again").alias("again"))
        .where("n > 1 or again")
        .select("root", "head", "group_id")
    )
    of_key = common.stored(rooted.select("key", "root").join(heads, "root").select("key", "head", "group_id"))
    here = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key", "unit")
    return found.join(of_key, "key").select(
        "doc_id", "text_key", "unit", F.floor(F.col("unit") / STRIDE).cast("int").alias("line"), F.lower(F.hex("group_id")).alias("group_id"), here.eqNullSafe(F.col("head")).alias("kept")
    )


def remove(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """All documents, all columns; ``text`` without the units that are not kept.

    A line that loses all its stretches goes; one that loses some is what is
    left of it. A document that loses all lines keeps its row with an empty
    text; one that loses nothing keeps its text as it is, null too.
    """
    gone = groups(docs, text, doc_id).where(~F.col("kept")).groupBy("doc_id", "text_key").agg(F.collect_set("unit").alias("__gone"))
    gone = gone.select(F.col("doc_id").alias("__id"), F.col("text_key").alias("__key"), "__gone")
    names = docs.columns
    own = docs.withColumn("__own", F.xxhash64(f"`{text}`"))
    both = own.join(gone, F.col(f"`{doc_id}`").eqNullSafe(F.col("__id")) & (F.col("__own") == F.col("__key")), "left")

    def rest(line: Column, i: Column) -> Column:
        def gone(j: Column) -> Column:
            return F.array_contains("__gone", i.cast("long") * F.lit(STRIDE) + j.cast("long"))

        parts = stretches(line)
        left = F.filter(parts, lambda s, j: ~gone(j))
        joined = F.array_join(left, "")
        # the white space that parted it from the last one
        ended = F.when((F.length(line) > 2 * STRETCH) & gone(F.size(parts) - 1), F.regexp_replace(joined, rf"{WHITE}\z", "")).otherwise(joined)
        return F.when(F.size(left) > 0, ended)

    lines = F.filter(F.transform(F.split(F.col(f"`{text}`"), "\n"), rest), lambda s: s.isNotNull())
    changed = F.when(F.col("__gone").isNull(), F.col(f"`{text}`")).otherwise(F.array_join(lines, "\n"))
    return both.select(*[changed.alias(c) if c == text else F.col(f"`{c}`") for c in names])
