"""The operators as queries over a data folder, with SQL where it can say the same."""

from __future__ import annotations

import public_tokenizers

from quayside.llm import (
    decontaminate,
    html,
    jaccard,
    language,
    lexical,
    licenses,
    packing,
    periodic,
    pii,
    quality,
    sharding,
    simhash,
    substrings,
)
from quayside.llm.common import table


def op1_pii(spark, d):
    return pii.personal_data(table(spark, d, "documents"))


def op2_html(spark, d):
    return html.main_texts(table(spark, d, "pages"))


def op3_sharding(spark, d):
    return sharding.shards(table(spark, d, "documents"))


def op4_simhash(spark, d):
    return simhash.simhash(table(spark, d, "documents"))


def op5_substrings(spark, d):
    return substrings.kept_words(table(spark, d, "documents"))


def op6_packing(spark, d):
    return packing.pack(table(spark, d, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op7_licenses(spark, d):
    return licenses.report(table(spark, d, "documents"))


def op8_quality(spark, d):
    return quality.judge(table(spark, d, "documents"), table(spark, d, "labels"))


def op9_decontaminate(spark, d):
    return decontaminate.contamination(table(spark, d, "documents"), table(spark, d, "benchmark"))


def op10_language(spark, d):
    return language.identify(table(spark, d, "documents"))


def op11_jaccard(spark, d):
    return jaccard.similar_groups(table(spark, d, "documents"))


def op12_search(spark, d):
    return lexical.search(lexical.index(table(spark, d, "documents")), table(spark, d, "benchmark"))


def op13_periodic(spark, d):
    return periodic.run_report(table(spark, d, "documents"), plant=True)


QUERIES = {
    f.__name__: f
    for f in (
        op1_pii,
        op2_html,
        op3_sharding,
        op4_simhash,
        op5_substrings,
        op6_packing,
        op7_licenses,
        op8_quality,
        op9_decontaminate,
        op10_language,
        op11_jaccard,
        op12_search,
        op13_periodic,
    )
}

_TERMS = r"""regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"""

ORACLES: dict[str, str] = {
    "op12_search": f"""
with doc as (select row_number() over () as r, doc_id, {_TERMS} as w from documents where text is not null),
held as (select r, doc_id, len(w) as n from doc where len(w) > 0),
tf as (select r, term, count(*) as tf from (select r, unnest(w) as term from doc) group by r, term),
df as (select term, count(*) as df from tf group by term),
total as (select count(*) as nn, sum(n)::bigint as l from held),
weighed as (select term, floor(1000 * ln((2 * nn + 2)::double / (2 * df + 1)::double))::bigint as w from df, total),
asked as (select row_number() over () as a, item_id, {_TERMS} as w from (select distinct item_id, text from benchmark)),
ask as (select a, item_id, term, count(*) as times from (select a, item_id, unnest(w) as term from asked) group by all),
scored as (
  select a, item_id, r, doc_id,
    sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * nn) // l))))::bigint as score
  from ask join weighed using (term) join tf using (term) join held using (r), total
  group by a, item_id, r, doc_id),
ranked as (select *, row_number() over (partition by a order by score desc, doc_id) as rank from scored where score > 0)
select item_id, rank::int as rank, doc_id, score from ranked where rank <= 10"""
}
