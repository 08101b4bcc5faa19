"""Personal data, and the terms that give it away according to the corpus."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.common import map_rows, null_safe, stored

KINDS = ("email", "ip", "card", "phone", "term")
WINDOW = 4  # words looked at on either side of an entity
SUPPORT = 3  # documents in which a term and an entity must meet before they are judged
GENERALISE = 0.7  # share of an entity's information that a term may give away
REMOVE = 0.9
VOCABULARY = 200_000  # terms a task counts before it passes counts on

# What counts as personal data.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
# A run of digits is entered at its start only: what fails there fails anywhere in it.
_IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_TERM = re.compile(r"[^\W_]+")
_DIGIT = re.compile(r"[0-9]")


def luhn(digits: str) -> bool:
    odd = sum(map(int, digits[::-2]))
    even = sum(d * 2 - 9 * (d > 4) for d in map(int, digits[-2::-2]))
    return (odd + even) % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost e-mail addresses, in one pass even over very long words."""
    end, sign = 0, text.find("@")
    while sign >= 0:
        start = sign
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, sign + 1) if start < sign else None
        if found:
            yield start, found.end()
        # A later address cannot begin before this sign, nor inside what has been found.
        end = found.end() if found else sign + 1
        sign = text.find("@", end)


def base(text: str) -> list[tuple[str, int, int]]:
    """Spans ``kind, start, end`` by start and kind; failing matches are dropped without retries."""
    out = [("email", a, b) for a, b in emails(text)]
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            parts = [p.lstrip("0") for p in m[0].split(".")]
            if all(len(p) <= 3 and int(p or 0) <= 255 for p in parts):
                out.append(("ip", *m.span()))
        for m in _CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", *m.span()))
        for m in _PHONE.finditer(text):
            if 9 <= len(_DIGIT.findall(m[0])) <= 15:
                out.append(("phone", *m.span()))
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


def entity(kind: str, value: str) -> str:
    """A name for what a span protects, alike for different spellings."""
    return f"{kind}:{value.lower() if kind in ('email', 'ip') else ''.join(_DIGIT.findall(value))}"


def surroundings(text: str, spans: list[tuple[str, int, int]], window: int = WINDOW) -> list[tuple]:
    """``entity, term, start, end`` of every place, outside all spans, of the words beside a span.

    A word beside an entity is taken wherever the text has it, so one that gives the entity away
    does not stay in another sentence.
    """
    beside: dict[str, set[str]] = {}
    # Of each stretch of overlapping spans the first start and the last end.
    starts, ends = [], []
    for _, a, b in sorted(spans, key=lambda s: s[1:]):
        if ends and a < ends[-1]:
            ends[-1] = max(ends[-1], b)
        else:
            starts.append(a)
            ends.append(b)
    for kind, a, b in spans:
        # Text enough for the words is cut out, then widened while it holds too few.
        for side in (-1, 1):
            reach = 64
            while True:
                low, high = (max(0, a - reach), a) if side < 0 else (b, min(len(text), b + reach))
                found = [m.span() for m in _TERM.finditer(text, low, high)]
                whole = low == 0 if side < 0 else high == len(text)
                if whole or len(found) > window:
                    break
                reach *= 2
            if not whole:  # the outermost word may be cut
                found = found[1:] if side < 0 else found[:-1]
            near = found[-window:] if side < 0 else found[:window]
            name = entity(kind, text[a:b])
            for s, e in near:
                if not any(s < q and p < e for _, p, q in spans):
                    beside.setdefault(text[s:e].lower(), set()).add(name)
    if not beside:
        return []
    out, at = [], 0
    for m in _TERM.finditer(text):
        s, e = m.span()
        names = beside.get(m[0].lower())
        if names:
            while at < len(ends) and ends[at] <= s:
                at += 1
            if at == len(ends) or starts[at] >= e:
                out += [(name, m[0].lower(), s, e) for name in sorted(names)]
    return out


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document its base spans, its entities and the terms around them; texts are not kept."""
    kind = docs.schema[key].dataType.simpleString()

    def work(rows: Iterator[tuple]) -> Iterator[tuple]:
        for k, h, t in rows:
            spans = base(t)
            names = sorted({entity(s[0], t[s[1] : s[2]]) for s in spans})
            yield (
                k, h, [{"kind": c, "a": a, "b": b} for c, a, b in spans], names,
                [{"e": e, "t": w, "a": a, "b": b} for e, w, a, b in surroundings(t, spans)],
            )

    schema = (
        f"`{key}` {kind}, h string, spans array<struct<kind:string,a:bigint,b:bigint>>, names array<string>, "
        "near array<struct<e:string,t:string,a:bigint,b:bigint>>"
    )
    whole = F.coalesce(F.col(text), F.lit(""))
    return map_rows(docs.select(key, F.md5(whole).alias("h"), whole.alias("t")), work, schema)


def term_counts(docs: DataFrame, text: str = "text", vocabulary: int = VOCABULARY) -> DataFrame:
    """Counts ``t, n`` of documents with a term, over the whole corpus, as partial sums of tasks."""

    def work(rows: Iterator[tuple]) -> Iterator[tuple]:
        counts: Counter = Counter()
        for (t,) in rows:
            counts.update(set(_TERM.findall(t.lower())))
            if len(counts) > vocabulary:
                yield from counts.items()
                counts.clear()
        yield from counts.items()

    return map_rows(docs.where(F.col(text).isNotNull()).select(text), work, "t string, n bigint")


def disclosures(docs: DataFrame, found: DataFrame, text: str = "text", support: int = SUPPORT,
                least: float = GENERALISE) -> DataFrame:
    """Pairs ``e, t, disclosure``: the share of an entity's information that a term gives away.

    Disclosure is the pointwise mutual information of term and entity over the information content
    of the entity, from counts of all documents: ln(n(e,t) N / (n(e) n(t))) / ln(N / n(e)). Pairs
    that meet in fewer than ``support`` documents are no evidence.
    """
    meets = found.select(F.explode(F.array_distinct(F.transform("near", lambda x: F.struct(x["e"], x["t"])))).alias("p"))
    both = stored(meets.groupBy("p.e", "p.t").agg(F.count("*").alias("n_et")).where(F.col("n_et") >= support), "pairs")
    terms = stored(both.select("t").distinct(), "terms")
    n_t = term_counts(docs, text).join(terms, "t", "left_semi").groupBy("t").agg(F.sum("n").alias("n_t"))
    n_e = found.select(F.explode("names").alias("e")).groupBy("e").agg(F.count("*").alias("n_e"))
    total = docs.agg(F.count("*")).first()[0]
    gain = F.log(F.col("n_et") * F.lit(float(total)) / (F.col("n_e") * F.col("n_t")))
    content = F.log(F.lit(float(max(1, total))) / F.col("n_e"))
    share = F.when(content > 0, gain / content).otherwise(0.0)
    return both.join(n_t, "t").join(n_e, "e").select("e", "t", share.alias("disclosure")).where(F.col("disclosure") >= least)


def telling(docs: DataFrame, found: DataFrame, key: str = "doc_id", text: str = "text", support: int = SUPPORT,
            least: float = GENERALISE) -> DataFrame:
    """Per document (key and text hash) the spans of terms whose disclosure is too high.

    Only documents with an entity take part. Their spans are gathered per document, which its
    length bounds; pairs shared by very many documents are joined with run-time skew handling.
    """
    pairs = disclosures(docs, found, text, support, least)
    # Repeated rows have equal spans, so one of them stands for all.
    each = found.where("size(near) > 0").select(key, "h", F.explode("near").alias("x")).select(key, "h", "x.*")
    marked = each.join(pairs, ["e", "t"]).groupBy(key, "h", "a", "b").agg(F.max("disclosure").alias("d"))
    return marked.groupBy(key, "h").agg(F.sort_array(F.collect_list(F.struct("a", "b", "d"))).alias("terms"))


def personal_data(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """Counts and spans of every document.

    ``doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_term``; spans are
    ``kind:start:end`` in code points. A NULL text is an empty one. Rows with a NULL or repeated
    id are told apart by their text; equal rows give equal results. Other columns are not read.
    """
    found = stored(scan(docs, key, text), "pii")
    terms = telling(docs, found, key, text, **options)
    rows = null_safe(found, terms, [key, "h"], "left")
    order = F.array(*[F.lit(k) for k in KINDS])
    more = F.coalesce(F.transform("terms", lambda x: F.struct(F.lit("term").alias("kind"), x["a"], x["b"])), F.array())

    def named(spans):
        placed = F.transform(
            spans, lambda s: F.struct(s["a"], F.array_position(order, s["kind"]).alias("k"), s["kind"], s["b"])
        )
        shown = F.transform(F.sort_array(placed), lambda s: F.concat_ws(":", s["kind"], s["a"], s["b"]))
        return F.array_join(shown, ",")

    base_only = named(F.col("spans"))
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("bigint").alias(f"n_{k}")
    return rows.select(
        key,
        *[count(k) for k in KINDS[:-1]],
        F.sha2(base_only.cast("binary"), 256).alias("base_sha256"),
        named(F.concat("spans", more)).alias("spans"),
        F.coalesce(F.size("terms"), F.lit(0)).cast("bigint").alias("n_term"),
    )


def generalised(word: str) -> str:
    """A term's class instead of the term."""
    return "[NUMBER]" if word.isdigit() else "[NAME]" if word[:1].isupper() else "[WORD]"


def clean(text: str, terms: list, remove: float = REMOVE) -> str:
    """The text with personal data masked, strongly telling terms removed and others generalised."""
    marks = [(a, b, f"[{k.upper()}]") for k, a, b in base(text)]
    marks += [(x["a"], x["b"], "" if x["d"] >= remove else generalised(text[x["a"] : x["b"]])) for x in terms]
    out, at = [], 0
    for a, b, mask in sorted(marks, key=lambda m: (m[0], -m[1])):
        if b <= at:
            continue
        out += [text[at:a], mask] if a >= at else []
        at = b
    return "".join([*out, text[at:]])


def sanitise(docs: DataFrame, key: str = "doc_id", text: str = "text", remove: float = REMOVE, **options) -> DataFrame:
    """Documents with personal data masked; all columns stay, and a column ``n_chars`` is set anew.

    Texts without personal data pass unchanged; NULL stays NULL.
    """
    found = stored(scan(docs, key, text), "pii")
    terms = stored(telling(docs, found, key, text, **options), "telling")
    terms = terms.withColumnsRenamed({"terms": "__terms", "h": "__h"})
    names = docs.columns
    marked = docs.withColumn("__h", F.md5(F.coalesce(F.col(text), F.lit(""))))
    rows = null_safe(marked, terms, [key, "__h"], "left").drop("__h")
    place, last = names.index(text), len(names)

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            texts, lists = batch.column(place).to_pylist(), batch.column(last).to_pylist()
            made = [t if t is None else clean(t, x or [], remove) for t, x in zip(texts, lists, strict=True)]
            column = pa.array(made, type=batch.schema.field(place).type)
            yield batch.set_column(place, batch.schema.field(place), column).select(list(range(last)))

    done = rows.mapInArrow(run, docs.schema)
    if "n_chars" in names:
        done = done.withColumn("n_chars", F.length(text).cast(docs.schema["n_chars"].dataType))
    return done
