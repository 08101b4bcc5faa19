"""Term search: a search column, blocked posting lists, web-style queries and ranking.

Words are runs of letters and digits in lower case; there is no stemming and no stop list.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD_BREAK = r"[^\p{L}\p{N}]+"
# Documents per posting block; a posting never holds more ids than this.
BLOCK = 65_536
# Score of one occurrence of the query, before it is divided by the gap.
COVER_WEIGHT = 0.1


def terms(*columns: Column | str) -> Column:
    """The words of several columns in order, as an array; NULL columns count as empty."""
    texts = [F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit("")) for c in columns]
    text = texts[0] if len(texts) == 1 else F.concat_ws(" ", *texts)
    return F.array_remove(F.split(F.lower(text), WORD_BREAK), "")


def add_search_column(rows: DataFrame, *columns: str, name: str = "search") -> DataFrame:
    """Store the words of the listed columns next to the row."""
    return rows.withColumn(name, terms(*columns))


@dataclass(frozen=True)
class Clause:
    """Words that must follow each other, wanted or unwanted."""

    words: tuple[str, ...]
    unwanted: bool = False


def web_query(text: str) -> list[list[Clause]]:
    """Read ``word "a phrase" -not or other`` as alternatives of clauses that must all hold."""
    alternatives: list[list[Clause]] = [[]]
    for minus, quoted, bare in re.findall(r'(-?)(?:"([^"]*)"?|([^\s"]+))', text):
        if bare.lower() == "or" and not minus:
            alternatives.append([])
            continue
        words = tuple(re.findall(r"[^\W_]+", (quoted or bare).lower()))
        if words:
            alternatives[-1].append(Clause(words, minus == "-"))
    return [a for a in alternatives if a]


def _padded(words: Column) -> Column:
    return F.concat(F.lit(" "), F.array_join(words, " "), F.lit(" "))


def _clause_holds(words: Column, clause: Clause) -> Column:
    if len(clause.words) == 1:
        found = F.array_contains(words, clause.words[0])
    else:
        found = F.contains(_padded(words), F.lit(f" {' '.join(clause.words)} "))
    return ~found if clause.unwanted else found


def matches(words: Column, query: str) -> Column:
    """Whether an array of words satisfies a web-style query; an empty query matches nothing."""
    groups = [
        reduce(lambda a, b: a & b, [_clause_holds(words, c) for c in clauses])
        for clauses in web_query(query)
    ]
    return reduce(lambda a, b: a | b, groups) if groups else F.lit(False)


def search(rows: DataFrame, query: str, words: str = "search") -> DataFrame:
    """Rows whose search column satisfies the query; no shuffle.

    The column is bound to a name first, so words made on the fly are made once per row and not
    once per clause.
    """
    return rows.where(F.exists(F.array(words), lambda bound: matches(bound, query)))


def wanted_words(query: str) -> list[str]:
    """The distinct words a document is ranked by."""
    found = [w for clauses in web_query(query) for c in clauses if not c.unwanted for w in c.words]
    return list(dict.fromkeys(found))


def frequency(words: Column, query: str) -> Column:
    """How often the query's words occur."""
    wanted = wanted_words(query)
    return F.size(F.filter(words, lambda w: w.isin(*wanted))).cast("bigint") if wanted else F.lit(0)


def cover_density(words: Column, query: str) -> Column:
    """Cover-density rank: every shortest span that holds all of the query's words adds 0.1
    divided by one plus the number of other words in it.

    One pass over the occurrences, keeping each word's last place.
    """
    wanted = wanted_words(query)
    if not wanted:
        return F.lit(0.0)
    places = F.filter(
        F.transform(words, lambda w, i: F.when(w.isin(*wanted), i)), lambda at: at.isNotNull()
    )
    numbered = F.array(*map(F.lit, wanted))
    hits = F.transform(
        places,
        lambda at: F.struct(at.alias("at"), F.array_position(numbered, F.get(words, at)).cast("int").alias("which")),
    )
    return _covers(hits, wanted)


def _covers(hits: Column, wanted: Sequence[str]) -> Column:
    """Cover density from the occurrences ``at, which`` (the word's number from 1) in order."""
    seen = F.transform(hits, lambda hit, nth: F.struct(hit["at"].alias("at"), hit["which"].alias("which"), nth.alias("nth")))
    none = F.struct(F.lit(-1).alias("at"), F.lit(-1).alias("nth"))
    start = F.struct(
        F.array(*[none for _ in wanted]).alias("last"), F.lit(0.0).alias("rank")
    )

    def step(state: Column, hit: Column) -> Column:
        last = state["last"]
        before = F.element_at(last, hit["which"])
        mine = F.struct(hit["at"].alias("at"), hit["nth"].alias("nth"))
        now = F.transform(last, lambda x, i: F.when(i + 1 == hit["which"], mine).otherwise(x))
        first = F.array_min(now)
        # A span is shortest when it is complete and did not already hold this word.
        new = (first["at"] >= 0) & (before["at"] < first["at"])
        other = (hit["at"] - first["at"]) - (hit["nth"] - first["nth"])
        gain = F.when(new, F.lit(COVER_WEIGHT) / (other + 1)).otherwise(F.lit(0.0))
        return F.struct(now.alias("last"), (state["rank"] + gain).alias("rank"))

    return F.aggregate(seen, start, step, lambda s: s["rank"])


def scored(
    rows: DataFrame, query: str, words: str = "search", method: str = "frequency"
) -> DataFrame:
    """Matching rows with their ``rank``, without the words and in no order.

    Test and score are one expression that gives one rank or none, so each row's words are read
    once; there is no shuffle.
    """
    score = {"frequency": frequency, "cover": cover_density}[method]

    def judge(bound: Column) -> Column:
        return F.when(matches(bound, query), F.array(score(bound, query)))

    verdict = F.get(F.transform(F.array(words), judge), F.lit(0))
    rest = [F.col(c) for c in rows.columns if c != words]
    return rows.select(*rest, F.explode(verdict).alias("rank"))


def ranked(
    rows: DataFrame,
    query: str,
    id_column: str,
    words: str = "search",
    method: str = "frequency",
    limit: int | None = None,
) -> DataFrame:
    """Scored rows, best first and then by id; ``limit`` keeps the top without a full sort."""
    best = scored(rows, query, words, method).orderBy(F.col("rank").desc(), id_column)
    return best if limit is None else best.limit(limit)


def inverted_index(
    rows: DataFrame, id_column: str, words: str = "search", block: int = BLOCK
) -> DataFrame:
    """Posting lists ``term, block, ids, n`` over an integer document id.

    Ids are grouped in blocks of consecutive numbers, so the list of a word that is everywhere is
    spread over many rows and tasks, and no row outgrows the block.
    """
    each = rows.select(
        F.explode(F.array_distinct(words)).alias("term"), F.col(id_column).alias("_id")
    )
    blocked = each.withColumn("block", F.call_function("div", F.col("_id") - F.pmod(F.col("_id"), F.lit(block)), F.lit(block)).cast("bigint"))
    # Ids are distinct per document already. Lists begun before the shuffle would hold few ids each
    # and fall back to sorting; shuffling the pairs first took half the time.
    placed = blocked.repartition("term", "block")
    lists = placed.groupBy("term", "block").agg(F.array_sort(F.collect_list("_id")).alias("ids"))
    return lists.withColumn("n", F.size("ids"))


def index_lookup(index: DataFrame, words: Sequence[str], id_name: str = "id") -> DataFrame:
    """Ids of documents that hold all the words, from the posting lists.

    Lists meet block by block: a group is one list per word, none longer than the block.
    """
    wanted = list(dict.fromkeys(w.lower() for w in words))
    met = (
        index.where(F.col("term").isin(*wanted))
        .groupBy("block")
        .agg(F.collect_list("ids").alias("lists"))
        .where(F.size("lists") == len(wanted))
    )
    both = F.reduce(
        F.slice("lists", F.lit(2), F.size("lists")), F.get("lists", F.lit(0)),
        lambda held, ids: F.array_intersect(held, ids),
    )
    return met.select(F.explode(both).alias(id_name))


def index_search(
    index: DataFrame, rows: DataFrame, query: str, id_column: str, words: str = "search"
) -> DataFrame:
    """Rows that satisfy a web-style query, found through posting lists.

    The lists of the wanted words give the candidates; only those rows are tested for phrases and
    unwanted words. With an index published by term (``publish(cluster_by=["term", "block"])``)
    the lookup reads the files of its words alone. A query with an alternative that wants no word
    has no lists to start from and scans all rows; the result is the same.
    """
    alternatives = [
        list(dict.fromkeys(w for c in clauses if not c.unwanted for w in c.words)) for clauses in web_query(query)
    ]
    if not all(alternatives):
        return search(rows, query, words)
    if not alternatives:
        return rows.where(F.lit(False))
    wanted = sorted({w for a in alternatives for w in a})
    met = (
        index.where(F.col("term").isin(*wanted))
        .groupBy("block")
        .agg(F.map_from_entries(F.collect_list(F.struct("term", "ids"))).alias("lists"))
    )

    def of(word: str) -> Column:
        return F.coalesce(F.try_element_at("lists", F.lit(word)), F.array().cast(index.schema["ids"].dataType))

    both = [reduce(F.array_intersect, [of(w) for w in a]) for a in alternatives]
    ids = met.select(F.explode(reduce(F.array_union, both)).alias("_candidate"))
    near = rows.join(ids, F.col(id_column) == F.col("_candidate"), "left_semi")
    return search(near, query, words)


# --- posting lists with places

POSITION_BLOCK = 4096
# Above any place in a text: a document's number in its block and a place make one number.
PLACES = 1 << 32
# Blocks of the greatest bounds that are ranked first, to learn what the others must reach.
LEADING_BLOCKS = 8


def positional_index(
    rows: DataFrame, id_column: str, words: str = "search", block: int = POSITION_BLOCK
) -> DataFrame:
    """Posting lists ``term, block, n, top, hits`` with every place of a word.

    ``hits`` are the occurrences ``id, at`` in order, ``n`` the documents and ``top`` the most
    occurrences in one of them, which bounds what the block can add to a rank. A block is a stretch of
    ids, so the list of a word that is everywhere is spread over many rows and tasks. Publish it with
    ``cluster_by=["term", "block"]``: lookups then read the files of their words alone.
    """
    kind, number = rows.schema[id_column].dataType, F.col(id_column).cast("bigint")
    start = F.col("block") * F.lit(block)
    # Whole documents move, to their block's task; words become rows there and are grouped in one sort, as numbers.
    whole = F.call_function("div", number - F.pmod(number, F.lit(block)), F.lit(block)).cast("bigint")
    placed = rows.select(whole.alias("block"), number.alias("id"), F.col(words).alias("words")).repartition("block")
    each = placed.select("block", F.coalesce(F.col("id") - start, F.lit(0)).alias("nth"), F.posexplode("words").alias("at", "term"))
    code = F.col("nth") * F.lit(PLACES) + F.col("at")
    lists = each.groupBy("term", "block").agg(F.sort_array(F.collect_list(code)).alias("codes"))
    # A document's occurrences follow each other: where the next one starts tells how many they are.
    begins = F.filter(
        F.transform("codes", lambda x, i: F.when((i == 0) | (_nth(x) != _nth(F.get("codes", i - 1))), i)), lambda i: i.isNotNull()
    )
    lists = lists.withColumn("begins", begins)
    ends = F.transform("begins", lambda b, k: F.coalesce(F.get("begins", k + 1), F.size("codes")) - b)
    hits = F.transform(
        "codes", lambda x: F.struct((_nth(x) + start).cast(kind).alias("id"), x.bitwiseAND(F.lit(PLACES - 1)).cast("int").alias("at"))
    )
    return lists.select("term", "block", F.size("begins").alias("n"), F.array_max(ends).alias("top"), hits.alias("hits"))


def _nth(code: Column) -> Column:
    return F.shiftright(code, 32)


def _clause_words(query: str) -> list[str]:
    return sorted({w for clauses in web_query(query) for c in clauses for w in c.words})


def index_matches(index: DataFrame, query: str, id_name: str = "id") -> DataFrame:
    """Ids of the documents that satisfy a web-style query, from a positional index alone.

    Phrases are places that follow each other, unwanted clauses are taken out; no text is read. Every
    alternative needs a wanted word, as lists only name documents that hold something.
    """
    return _matched(index, query).select(F.col("id").alias(id_name))


def _matched(index: DataFrame, query: str) -> DataFrame:
    alternatives = web_query(query)
    if any(all(c.unwanted for c in clauses) for clauses in alternatives):
        raise ValueError(f"an alternative of {query!r} wants no word; scan the rows instead")
    kind = index.schema["hits"].dataType
    near = index.where(F.col("term").isin(*_clause_words(query)))
    # One column a word: kept by sorting, a block at a time. Maps of lists would be kept for many blocks at once.
    held_as = {w: f"_list_{i}" for i, w in enumerate(_clause_words(query))}
    met = near.groupBy("block").agg(
        *[F.first(F.when(F.col("term") == w, F.col("hits")), ignorenulls=True).alias(c) for w, c in held_as.items()],
        F.min(F.get("hits", F.lit(0))["id"]).alias("start"),
    )

    def hits(word: str) -> Column:
        return F.coalesce(F.col(held_as[word]), F.array().cast(kind))

    def holders(clause: Clause) -> Column:
        # Numbers meet by hashing; arrays of structs would be compared pair by pair.
        def begun(k: int, word: str) -> Column:
            late = F.filter(hits(word), lambda h: h["at"] >= k) if k else hits(word)
            return F.transform(late, lambda h: (h["id"] - F.col("start")) * F.lit(PLACES) + (h["at"] - k))

        if len(clause.words) == 1:
            return F.array_distinct(F.transform(hits(clause.words[0]), lambda h: h["id"]))
        starts = [begun(k, w) for k, w in enumerate(clause.words)]
        ids = F.transform(
            reduce(F.array_intersect, starts),
            lambda x: (F.call_function("div", x, F.lit(PLACES)) + F.col("start")).cast(kind.elementType["id"].dataType),
        )
        return F.array_distinct(ids)

    found = F.array().cast(f"array<{kind.elementType['id'].dataType.simpleString()}>")
    for clauses in alternatives:
        held = reduce(F.array_intersect, [holders(c) for c in clauses if not c.unwanted])
        for c in clauses:
            if c.unwanted:
                held = F.array_except(held, holders(c))
        found = F.array_union(found, held)
    return met.select("block", F.explode(found).alias("id"))


def _index_scores(index: DataFrame, query: str, method: str) -> DataFrame:
    """``id, rank`` of all matching documents in the blocks of ``index``."""
    wanted = wanted_words(query)
    places = index.where(F.col("term").isin(*wanted)).select("block", "term", F.inline("hits"))
    matched = _matched(index, query)
    if method == "frequency":
        counts = places.groupBy("block", "id").agg(F.count("*").alias("rank"))
    else:
        numbered = F.array(*map(F.lit, wanted))
        hit = F.struct("at", F.array_position(numbered, F.col("term")).cast("int").alias("which"))
        counts = places.groupBy("block", "id").agg(_covers(F.array_sort(F.collect_list(hit)), wanted).alias("rank"))
    return matched.join(counts, ["block", "id"]).select("id", "rank")


def index_ranked(
    index: DataFrame, query: str, id_name: str = "id", method: str = "frequency", limit: int | None = None
) -> DataFrame:
    """Matching documents with their rank from a positional index, best first and then by id.

    With a ``limit`` the blocks that may score highest are ranked first; of the others only those are
    read whose bound reaches the last rank found there. Ranks are those of :func:`ranked`.
    """
    if method not in ("frequency", "cover"):
        raise KeyError(method)
    if not wanted_words(query):
        return _matched(index, query).select(F.col("id").alias(id_name), F.lit(0).alias("rank"))
    order = [F.col("rank").desc(), F.col(id_name)]
    if limit is None:
        return _index_scores(index, query, method).withColumnRenamed("id", id_name).orderBy(*order)
    # An occurrence adds one to the frequency and ends at most one span, which adds the cover weight.
    each = {"frequency": F.lit(1), "cover": F.lit(COVER_WEIGHT)}[method]
    bounds = index.where(F.col("term").isin(*wanted_words(query))).groupBy("block").agg((F.sum("top") * each).alias("bound"))
    leading = [r["block"] for r in bounds.orderBy(F.col("bound").desc(), "block").limit(LEADING_BLOCKS).collect()]
    first = _index_scores(index.where(F.col("block").isin(leading)), query, method)
    ranks = [r["rank"] for r in first.orderBy(F.col("rank").desc()).limit(limit).select("rank").collect()]
    reach = ranks[-1] if len(ranks) == limit else 0
    # A rank is a sum of fractions; a bound that is hardly lower is looked at.
    near = bounds.where(F.col("bound") >= reach - 1e-9).select("block")
    # A number for thousands of documents: lists are not moved to find which are read.
    rest = index.join(F.broadcast(near), "block", "left_semi")
    return _index_scores(rest, query, method).withColumnRenamed("id", id_name).orderBy(*order).limit(limit)
