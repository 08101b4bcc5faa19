"""Substrings, decontamination, packing, quality and PII against plain Python."""

import hashlib
import random
import re
import zlib
from collections import Counter

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from conftest_llm import prose
from quayside.llm import decontaminate, packing, pii, quality, substrings

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# --- substrings


def slow_repeats(docs):
    seen, out = {}, []
    words = {i: (t or "").encode().split() for i, t in docs}
    for i, w in words.items():
        for s in range(len(w) - 49):
            k = b" ".join(w[s : s + 50])
            seen[k] = min(seen.get(k, i), i)
    for i, w in words.items():
        gone = set()
        for s in range(len(w) - 49):
            if seen[b" ".join(w[s : s + 50])] < i:
                gone.update(range(s, s + 50))
        kept = b" ".join(x for n, x in enumerate(w) if n not in gone).decode()
        out.append((i, len(w), len(gone), sha(kept)))
    return sorted(out)


def test_substrings_against_all_windows(frame):
    r = random.Random(4)
    shared = [prose(100 + i, n).split() for i, n in enumerate((49, 50, 51, 60, 90, 200, 400))]
    texts = [None, "", "one two", prose(7, 5000)]
    for i in range(60):
        words = prose(i, r.randint(0, 120)).split()
        for _ in range(r.randint(0, 3)):
            p = r.choice(shared)
            a = r.randint(0, len(p) // 3)
            at = r.randint(0, len(words))
            words[at:at] = p[a : len(p) - r.randint(0, len(p) // 3)]
        texts.append(" \n".join(words))
    texts += texts[5:12] + ["same word " * 80, "same word " * 90]
    r.shuffle(texts)
    got = substrings.kept_words(frame(texts)).collect()
    assert sorted(map(tuple, got)) == slow_repeats(list(enumerate(texts)))
    assert any(0 < g["n_removed"] < g["n_words"] for g in got)


def test_substrings_null_and_repeated_ids(frame):
    t = prose(1, 80)
    rows = [(i, t, None, None, None, "", "", 0) for i in (None, 3, 3, 5)]
    got = sorted((str(g["doc_id"]), g["n_removed"]) for g in substrings.kept_words(frame(rows)).collect())
    assert got == [("3", 0), ("3", 0), ("5", 80), ("None", 0)]
    assert substrings.kept_words(frame([])).count() == 0


# --- decontamination


def slow_hits(text, items, n=10):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    w, hit, names = words(text), set(), set()
    for item, t in items:
        v = words(t)
        size = min(n, len(v))
        for i in range(len(v) - size + 1 if v else 0):
            for s in range(len(w) - size + 1):
                if w[s : s + size] == v[i : i + size]:
                    hit.update(range(s, s + size))
                    names.add(item)
    names = sorted(str(x) for x in names if x is not None)
    return len(w), len(hit), len(names), sha(",".join(names)), bool(hit)


def test_decontamination_against_all_windows(spark, frame):
    items = [(i, prose(500 + i, 30)) for i in range(12)] + [(12, "just four ÉT words"), (13, ""), (14, None), (None, prose(900, 12))]
    items.append((15, items[0][1]))
    texts = [None, "", "123 !!", prose(1, 300), "say JUST four Ét-words now", items[0][1], prose(900, 12)]
    for i in range(8):
        part = items[i][1].split()[i : i + 12 + i]
        texts.append(prose(i, 40) + ". " + ", ".join(part).upper() + "; " + prose(50 + i, 30))
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    want = sorted((i, *slow_hits(t, items)) for i, t in enumerate(texts))
    for limit in (1 << 20, 400):  # one block, and many
        got = decontaminate.contamination(frame(texts), benchmark, limit=limit).collect()
        assert sorted(map(tuple, got)) == want
    kept = decontaminate.decontaminate(frame(texts), benchmark)
    assert kept.columns == frame([]).columns
    assert all(r["n_chars"] == len(r["text"] or "") for r in kept.collect())
    left = {r["doc_id"]: r["text"] for r in kept.collect()}
    assert left[0] is None and left[1] == "" and left[3] == texts[3]
    assert 5 not in left and 4 not in left
    assert all(slow_hits(left[i], items)[1] == 0 for i in left)
    assert prose(7, 40) in left[14]
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert not any(r["contaminated"] for r in decontaminate.contamination(frame(texts), none).collect())
    assert decontaminate.contamination(frame([]), benchmark).count() == 0


def test_decontamination_does_not_depend_on_blocks(spark, frame):
    passage = prose(700, 40).split()
    # Overlapping items, and enough others that they are dealt to several blocks.
    items = [(i, " ".join(passage[3 * i : 3 * i + 13])) for i in range(10)]
    items += [(100 + i, prose(800 + i, 20)) for i in range(20)]
    texts = [None, "", prose(1, 60), " ".join(passage) + " " + prose(2, 20), prose(3, 90) + " " + " ".join(passage)]
    texts += [" ".join(prose(800 + i + j, 20) for j in range(4)) + " " + prose(40 + i, 70) for i in range(8)]
    texts += [prose(60, 20) + " " + prose(800, 20)[:40] + " " + prose(801, 20) + " " + prose(61, 25)]
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    one = sorted(map(tuple, decontaminate.decontaminate(frame(texts), benchmark).collect()), key=lambda r: r[0])
    many = decontaminate.decontaminate(frame(texts), benchmark, limit=400)
    assert many.columns == frame([]).columns
    assert sorted(map(tuple, many.collect()), key=lambda r: r[0]) == one
    assert 3 not in {r[0] for r in one} and 4 in {r[0] for r in one}


# --- packing


def test_first_fit_decreasing():
    r = random.Random(2)
    sizes = [r.randint(1, 100) for _ in range(300)]
    bins = []
    want = {}
    for i in sorted(range(300), key=lambda i: -sizes[i]):
        b = next((k for k, used in enumerate(bins) if used + sizes[i] <= 100), len(bins))
        bins += [0] * (b == len(bins))
        want[i] = (b, bins[b])
        bins[b] += sizes[i]
    assert packing.first_fit_decreasing(sizes, 100) == [want[i] for i in range(300)]
    assert packing.first_fit_decreasing([5], 5) == [(0, 0)] and packing.first_fit_decreasing([], 5) == []


def test_packing_round_trip(frame):
    texts = [None, "", prose(1, 4000), "a  b\n\nc<|endoftext|>d don't. 漢字 x y", prose(2, 30), prose(2, 30), " lead", "trail \n"]
    texts += [prose(i, 20 + 7 * i) for i in range(60)]
    model = Tokenizer.from_file(VOCABULARY)
    want = {i: [*model.encode(t or "", add_special_tokens=False).ids, 1] for i, t in enumerate(texts)}
    got = packing.pack(frame(texts), VOCABULARY, group=20).collect()
    used = Counter()
    spans = {}
    for g in got:
        ids = want[g["doc_id"]][g["start"] : g["start"] + g["length"]]
        assert len(ids) == g["length"] and g["doc_tokens"] == len(want[g["doc_id"]])
        assert zlib.crc32(b"".join(x.to_bytes(4, "little") for x in ids)) == g["ids_crc32"]
        used[g["doc_id"]] += g["length"]
        spans.setdefault(g["sequence_id"], []).append((g["offset"], g["length"]))
    assert used == {i: len(w) for i, w in want.items()}
    for parts in spans.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    assert packing.pack(frame([]), VOCABULARY).count() == 0
    whole = packing.sequences(frame(texts), VOCABULARY, pad=2).collect()
    assert all(len(r["ids"]) == 2048 for r in whole)
    ids = Counter(x for r in whole for x in r["ids"])
    assert ids[1] == Counter(x for w in want.values() for x in w)[1]


def test_packing_repeated_and_null_ids(frame):
    rows = [(i, t, None, None, None, "", "", 0) for i in (None, 1, 1) for t in ("same", "same", None)]
    got = packing.pack(frame(rows), VOCABULARY).collect()
    assert len(got) == 9 and len({(g["sequence_id"], g["offset"]) for g in got}) == 9


# --- quality


def slow_counts(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    c = Counter(zip(w, w[1:], w[2:], strict=False))
    covered = {i + k for i in range(len(w) - 2) if c[tuple(w[i : i + 3])] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    counts = (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered))
    return (*counts, len(w) < 50 or 100 * len(covered) > 50 * len(w))


def test_quality_counts(spark, frame):
    texts = [None, "", "a b c a b c", "x y z\nx y z\n \n\x0b\nx y z", "é#$ ü|<> ß", prose(1, 6000), "a a a a a", "w " * 300, prose(1, 60) + "\n" + prose(1, 60)]
    labels = spark.createDataFrame([(0, 1, 0), (None, 1, 0)], "doc_id bigint, quality int, toxic int")
    got = sorted(map(tuple, quality.judge(frame(texts), labels).collect()))
    assert [g[:-1] for g in got] == [(i, *slow_counts(t)) for i, t in enumerate(texts)]
    assert all(g[-1] == (not g[-2]) for g in got)  # no label can certify a cutoff here
    assert quality.judge(frame([]), labels).count() == 0
    assert quality.judge(frame(texts), labels.limit(0)).count() == len(texts)


def exact_allowed(n, alpha, delta):
    from fractions import Fraction
    from math import comb

    p, total, best = Fraction(alpha), Fraction(0), -1
    for k in range(n + 1):
        total += comb(n, k) * p**k * (1 - p) ** (n - k)
        if total > Fraction(delta):
            return best
        best = k
    return best


def test_allowed_rejections_are_exact(spark):
    from pyspark.sql import functions as F

    sizes = [1, 50, 148, 149, 300, 700, 1500]
    frame = spark.createDataFrame([(n,) for n in sizes], "n bigint")
    for alpha, delta in ((0.02, 0.05), (0.1, 0.001), (0.02 / 3, 0.05 / 12)):
        got = dict(frame.select("n", quality.allowed(F.col("n"), alpha, F.lit(delta))).collect())
        assert got == {n: exact_allowed(n, alpha, delta) for n in sizes}
    big = spark.range(1).select(quality.allowed(F.lit(10_000_000), 0.02, F.lit(0.01))).first()[0]
    assert 198_500 < big < 200_000


def test_certified_cutoffs(spark, frame):
    r = random.Random(6)
    texts = []
    for i in range(2400):
        marks = 0 if i % 60 else 30
        texts.append(prose(i, 60) + " " + "#" * (marks if i < 2000 else 60 * (r.random() < 0.9)))
    rows = [(i, t, "en" if i % 2 else None, "s", 0, "", "", 0) for i, t in enumerate(texts)]
    labels = spark.createDataFrame([(i, int(i < 2000), 0) for i in range(2400)], "doc_id bigint, quality int, toxic int")
    got = {g["doc_id"]: g for g in quality.judge(frame(rows), labels, alpha=0.06, delta=0.05).collect()}
    good = [g for i, g in got.items() if i < 2000 and not g["base_failed"]]
    assert sum(not g["kept"] for g in good) <= 0.06 * len(good)
    bad = [g for i, g in got.items() if i >= 2000 and g["n_symbols"] == 60 and not g["base_failed"]]
    assert bad and not any(g["kept"] for g in bad)


# --- personal data


def slow_base(text):
    email = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
    ip = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
    card, phone = re.compile(r"[0-9]([\x20-]?[0-9])+"), re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

    def luhn(s):
        d = [int(c) for c in s if c in "0123456789"]
        return 12 <= len(d) <= 19 and sum(x if i % 2 == 0 else sum(divmod(2 * x, 10)) for i, x in enumerate(d[::-1])) % 10 == 0

    out = [(m.start(), 0, "email", m.end()) for m in email.finditer(text)]
    out += [(m.start(), 1, "ip", m.end()) for m in ip.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    out += [(m.start(), 2, "card", m.end()) for m in card.finditer(text) if luhn(m[0])]
    out += [(m.start(), 3, "phone", m.end()) for m in phone.finditer(text) if 9 <= sum(c in "0123456789" for c in m[0]) <= 15]
    return ",".join(f"{k}:{a}:{b}" for a, _, k, b in sorted(out))


def spotted(text):
    return ",".join(f"{k}:{a}:{b}" for k, a, b in pii.base(text))


def test_base_spans_against_patterns():
    r = random.Random(8)
    parts = ["a@b.co", "@", ".", "x.y+z", "-", "_", " ", "+1 (234) 555-0199", "4111 1111 1111 1111", "10.0.0.255", "1.2.3.256", "00012", "é", "9" * 13, "a@b", "c%d", "\n", "@e.f", "5500-0000-0000-0004"]
    for _ in range(6000):
        text = "".join(r.choice(parts) for _ in range(r.randint(0, 9)))
        assert spotted(text) == slow_base(text), text


def test_long_words_take_linear_time():
    assert pii.base("a" * 2_000_000 + " x@y.zz " + "1" * 2_000_000)[0][0] == "email"


def test_telling_terms(frame):
    texts = [None, "", prose(1, 500)]
    for i in range(6):
        texts.append(f"{prose(i, 20)} Zanzibar write to ann@x.org now {prose(40 + i, 20)}")
    texts += [f"{prose(80 + i, 30)} write to {prose(90 + i, 5)}" for i in range(30)]
    got = {g["doc_id"]: g for g in pii.personal_data(frame(texts)).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        kinds = got[i]["spans"].split(",") if got[i]["spans"] else []
        based = ",".join(k for k in kinds if not k.startswith("term"))
        assert based == slow_base(t or "") and got[i]["base_sha256"] == sha(based)
        terms = {(t or "")[int(k.split(":")[1]) : int(k.split(":")[2])] for k in kinds if k.startswith("term")}
        assert ("Zanzibar" in terms) == (3 <= i < 9)
        assert "write" not in terms or 3 <= i < 9
        assert got[i]["n_email"] == (3 <= i < 9)
    clean = pii.sanitise(frame(texts))
    left = {r["doc_id"]: r for r in clean.collect()}
    assert left[0]["text"] is None and left[2]["text"] == texts[2] and left[20]["text"] == texts[20]
    assert "Zanzibar" not in left[4]["text"] and "[EMAIL]" in left[4]["text"] and "@" not in left[4]["text"]
    assert left[4]["n_chars"] == len(left[4]["text"])


def test_pii_odd_rows(frame):
    assert pii.personal_data(frame([])).count() == 0
    assert pii.sanitise(frame([])).columns == frame([]).columns
    rows = [(None, "a@b.cd", None, None, None, "", "", 0)] * 3 + [(1, "e@f.gh", None, None, None, "", "", 0), (1, "x", None, None, None, "", "", 0)]
    got = sorted((str(g["doc_id"]), g["n_email"]) for g in pii.personal_data(frame(rows)).collect())
    assert got == [("1", 0), ("1", 1), ("None", 1), ("None", 1), ("None", 1)]


@pytest.mark.parametrize("digits, fine", [("4111111111111111", True), ("4111111111111112", False)])
def test_luhn(digits, fine):
    assert pii.luhn(digits) is fine


def test_a_telling_word_goes_wherever_its_text_has_it(frame):
    texts = [f"Write to Zamboni at ann@x.io soon. {prose(i, 20)} Then ZAMBONI said, and zamboni wrote, {prose(90 + i, 9)}" for i in range(6)]
    texts += [prose(200 + i, 60) for i in range(60)]
    docs = frame(texts)
    for x in pii.personal_data(docs).collect():
        if x["doc_id"] < 6:
            text = texts[x["doc_id"]]
            marked = {text[int(s.split(":")[1]) : int(s.split(":")[2])].lower() for s in x["spans"].split(",") if s.startswith("term")}
            assert "zamboni" in marked and x["spans"].count("term:") >= 3
    for x in pii.sanitise(docs).collect():
        assert "zamboni" not in x["text"].lower() and "ann@" not in x["text"]
        assert x["doc_id"] < 6 or x["text"] == texts[x["doc_id"]]


def test_places_of_words_beside_spans():
    r = random.Random(1)
    for _ in range(300):
        parts = [r.choice(["a@b.io", "+1 555 123 4567", "1.2.3.4", "w1", "W1", "w2", "w3,", "4111 1111 1111 1111", "w4 w5 w6 w7"]) for _ in range(r.randint(0, 12))]
        text = r.choice([" ", ". "]).join(parts)
        spans = pii.base(text)
        got = pii.surroundings(text, spans)
        words = [m.span() for m in re.finditer(r"[^\W_]+", text)]
        want = set()
        for kind, a, b in spans:
            before = [w for w in words if w[1] <= a][-pii.WINDOW :]
            after = [w for w in words if w[0] >= b][: pii.WINDOW]
            free = [w for w in words if not any(w[0] < q and p < w[1] for _, p, q in spans)]
            near = {text[s:e].lower() for s, e in before + after if (s, e) in free}
            want |= {(pii.entity(kind, text[a:b]), text[s:e].lower(), s, e) for s, e in free if text[s:e].lower() in near}
        assert set(got) == want and len(got) == len(want)
