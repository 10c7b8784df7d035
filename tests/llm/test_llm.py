"""Operators of the llm subpackage, against brute force and in their edge cases."""

import itertools
import random
import sys
import zlib
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from provlake.llm.consistent import words
from provlake.llm import consistent as cons
from provlake.llm import leaked_items, look_alike, near_duplicates, packing, residue, text_quality


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


# ---- consistent text --------------------------------------------------------


@pytest.mark.parametrize(
    "a, b, same",
    [
        ("find", "ﬁnd", True), ("70.3 %", "７０．３ ％", True), ("résumé", "résumé", True), ("summary", "sum​ma­ry", True), ("a b", "a b", True), ("notice", "nоtісе", True), ("last", "laﬅ", True), ("s", "ſ", False), ("Vendor-4", "Vendor‐4", True),
        ("resume", "résumé", False), ("o", "ø", False), ("2", "²", False), ("2", "₂", False), ("Dor", "dor", False), ("a, b", "a b", False), ("a\nb", "a b", False), ("1", "l", False), ("a–b", "a-b", False),
    ],
)
def test_skeleton(a, b, same):
    assert (cons.skeleton(a) == cons.skeleton(b)) is same


@given(st.text(max_size=60))
@settings(max_examples=150, deadline=None)
def test_skeleton_is_settled(t):
    s = cons.skeleton(t)
    assert cons.skeleton(s) == s and cons.skeleton(cons.consistent(t)) == s


def test_words_are_runs_of_letters_and_digits():
    assert cons.words("It’s 27.3% of Ｈálb-9_x") == [w.encode() for w in ["it", "s", "27", "3", "of", "hálb", "9", "x"]]
    assert cons.words("") == [] and cons.words(None) == []


def test_look_alike_pairs(spark):
    rows = [(1, "find it"), (2, "ﬁnd it"), (3, "find it"), (4, None), (5, ""), (6, ""), (7, "fínd it"), (8, "find​ it"), (None, "find it")]
    df = frame(spark, rows, "capture_id bigint, t string").selectExpr("*", "1 as id", "2 as text")
    got = {tuple(r) for r in look_alike.look_alike_pairs(df, "capture_id", "t").collect()}
    assert got == {(1, 2), (2, 3), (1, 8), (2, 8), (3, 8)}
    classes = {r["capture_id"]: (r["class_id"], r["n_records"], r["n_spellings"]) for r in look_alike.look_alike_classes(df, "capture_id", "t").collect()}
    assert classes[8] == (1, 4, 3) and classes[7] == (7, 1, 1) and classes[6] == (5, 2, 1) and 4 not in classes
    empty = df.limit(0)
    assert look_alike.look_alike_pairs(empty, "capture_id", "t").count() == 0
    text = {r[0]: r[1] for r in look_alike.consistent_text(df.where("capture_id is not null"), "capture_id", "t").collect()}
    assert text[2] == "find it" and text[4] is None and text[7] == "fínd it"


# ---- near duplicates ---------------------------------------------------------


def corpus(n, seed):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(300)]
    rows, base = [], []
    for i in range(n):
        if base and rng.random() < 0.6:
            w = list(rng.choice(base))
            for _ in range(rng.choice([0, 1, 2, 4, 8, 16])):
                at = rng.randrange(len(w))
                w[at : at + rng.choice([0, 1, 1, 3])] = [rng.choice(vocabulary)]
            if rng.random() < 0.2:
                k = rng.randrange(len(w))
                w = w[k:] + w[:k]
        else:
            w = [rng.choice(vocabulary[:40] if rng.random() < 0.3 else vocabulary) for _ in range(rng.randrange(20, 130))]
            base.append(w)
        rows.append((i + 1, " ".join(w)))
    return rows


def brute(rows, least=40):
    sets = {}
    for i, t in rows:
        w = cons.words(t)
        if len(w) >= least:
            sets[i] = {tuple(w[k : k + 3]) for k in range(len(w) - 2)}
    return {(a, b) for a, b in itertools.combinations(sorted(sets), 2) if len(sets[a] & sets[b]) * 5 >= 3 * len(sets[a] | sets[b])}


@pytest.mark.parametrize("heavy, hot", [(1 << 18, 4096), (8, 4096), (0, 4096), (1 << 18, 3)])
def test_near_duplicates_lose_no_pair(spark, monkeypatch, heavy, hot):
    """Whatever the order of the index, and with hot runs dealt into blocks, the pairs are those of brute force."""
    monkeypatch.setattr(near_duplicates, "HEAVY", heavy)
    monkeypatch.setattr(near_duplicates, "HOT", hot)
    rows = corpus(260, 5)
    df = frame(spark, rows, "capture_id bigint, t string")
    got = [tuple(r) for r in near_duplicates.near_duplicate_pairs(df, "capture_id", "t").collect()]
    assert len(got) == len(set(got)) and set(got) == brute(rows) and len(got) > 50


def test_near_duplicates_on_copies_and_odd_rows(spark):
    """A third of all rows are copies, some of them disguised; short sets of runs, nulls and a very long text."""
    base = corpus(30, 9)
    copy = " ".join(f"c{k}" for k in range(60))
    rows = base + [(100 + k, copy if k % 2 else copy.replace("c1 ", "ｃ1 ")) for k in range(20)]
    rows += [(200, None), (201, ""), (202, "a " * 50), (203, "a " * 60), (204, " ".join(f"l{k}" for k in range(60_000))), (205, "a " * 39)]
    df = frame(spark, rows, "capture_id bigint, t string").selectExpr("*", "t as text", "0 as rep")
    got = [tuple(r) for r in near_duplicates.near_duplicate_pairs(df, "capture_id", "t").collect()]
    assert len(got) == len(set(got)) and set(got) == brute([r for r in rows if r[1]])
    assert (202, 203) in got
    groups = {r["capture_id"]: r for r in near_duplicates.near_duplicate_groups(df, "capture_id", "t").collect()}
    assert {groups[100 + k]["class_id"] for k in range(20)} == {100} and 200 not in groups and 205 not in groups
    parent = {i: i for i in groups}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in got:
        parent[max(find(a), find(b))] = min(find(a), find(b))
    assert {i: find(i) for i in groups} == {i: r["group_id"] for i, r in groups.items()}
    assert near_duplicates.near_duplicate_pairs(df.limit(0), "capture_id", "t").count() == 0


def test_slices_of_a_batch_give_what_the_batch_gives(monkeypatch):
    """Sets, entries and verification in small slices, for batches of very long texts."""
    import pyarrow as pa

    rows = corpus(60, 3)
    whole = pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows]), pa.array([r[1] for r in rows])], names=["id", "text"])

    class Heavy:
        value = (near_duplicates.np.zeros(0, "int64"), near_duplicates.np.zeros(0, "int64"))

    def run():
        sets = pa.Table.from_batches(near_duplicates._sets([whole], 40)).combine_chunks().to_batches()[0]
        entries = pa.Table.from_batches(near_duplicates._entries([sets.select(["id", "words"])], Heavy, 4096)).to_pylist()
        pair = pa.RecordBatch.from_arrays([sets["id"], sets["id"], sets["words"], sets["words"].take(pa.array(range(len(sets))[::-1]))], names=["a", "b", "wa", "wb"])
        return sets.to_pylist(), entries, pa.Table.from_batches(near_duplicates._verify([pair])).to_pylist(), sum(r["c"] for b in near_duplicates._counts([sets.select(["words"])]) for r in b.to_pylist())

    want = run()
    monkeypatch.setattr(near_duplicates, "FLUSH", 100)
    assert run() == want


def test_components_of_a_long_chain(spark):
    from provlake.session import Stash

    edges = frame(spark, [(k, k + 1) for k in range(40)] + [(100, 101)], "a bigint, b bigint")
    got = {r["id"]: r["root"] for r in near_duplicates.components(Stash(spark), edges).collect()}
    assert all(got[k] == 0 for k in range(1, 41)) and got[101] == 100


# ---- leaked items ------------------------------------------------------------


def test_leaked_items_against_brute_force(spark):
    rng = random.Random(3)
    items = [(k, " ".join(f"q{rng.randrange(400)}" for _ in range(rng.randrange(8, 60)))) for k in range(30)] + [(99, None), (98, "")]
    docs = []
    for i in range(80):
        w = [f"d{rng.randrange(200)}" for _ in range(40)]
        for _ in range(rng.randrange(3)):
            own = items[rng.randrange(30)][1].split()
            n = rng.randrange(6, 22)
            a = rng.randrange(max(1, len(own) - n))
            w[rng.randrange(len(w)) : 0] = own[a : a + n]
        sep = rng.choice([" ", "\n", ", ", " "])
        docs.append((i, sep.join(w).upper() if i % 5 == 0 else sep.join(w)))
    docs += [(500, None), (501, ""), (502, items[0][1].replace("q", "ｑ"))]

    def shared(a, b):
        a, b = cons.words(a), cons.words(b)
        runs = {tuple(b[k : k + 13]) for k in range(len(b) - 12)}
        return any(tuple(a[k : k + 13]) in runs for k in range(len(a) - 12))

    want = {(i, k) for i, t in docs for k, q in items if t and q and shared(t, q)}
    d, q = frame(spark, docs, "doc_id bigint, text string").selectExpr("*", "7 as item_id"), frame(spark, items, "item_id bigint, text string")
    got = [tuple(r) for r in leaked_items.leaked_items(d, "doc_id", "text", q, "item_id", "text").collect()]
    assert len(got) == len(set(got)) and set(got) == want and len(want) > 10
    small = {tuple(r) for r in leaked_items.leaked_passages(d, "doc_id", "text", q, "item_id", "text", most=300).select("doc_id", "item_id").distinct().collect()}
    assert small == want  # several automata
    for r in leaked_items.leaked_passages(d, "doc_id", "text", q, "item_id", "text").collect():
        text = dict(docs)[r["doc_id"]]
        assert len(cons.words(text[r["start_char"] : r["end_char"]])) == r["n_words"]
    assert leaked_items.leaked_items(d, "doc_id", "text", q.limit(0), "item_id", "text").count() == 0
    assert leaked_items.leaked_items(d.limit(0), "doc_id", "text", q, "item_id", "text").count() == 0


# ---- residue -------------------------------------------------------------------


def captures(spark, n=240):
    rng = random.Random(1)
    plain = ["Auditors counted {} pages of {} in the second year of the survey.", "The summary lists {} sources and {} licences by region.", "Publishers asked for {} changes, of which {} were made.", "Most of the {} records come from public archives."]
    told = ['The phrase "page not found" appeared in old copies and was kept as evidence.', "Sites that need JavaScript are rendered first, which affected {} pages.", "The official form shows {{{{model_name}}}} as a sample field; providers must replace it."]
    bad = ["{{{{model_name}}}}", "[INSERT VERSION]", "${{title}}", "<%= size %>", "undefined"]
    errors = ["Page not found.", "Please enable JavaScript to view this page.", "Error 503: Service unavailable, come back soon.", "Your text here. Your text here."]
    rows, manifest, cases = [], [], set()
    for i in range(n):
        sentences = [rng.choice(plain).format(rng.randrange(99), rng.randrange(99)) for _ in range(rng.randrange(3, 8))]
        kind = rng.random()
        if kind < 0.15:
            s = sentences[0].split(" ")
            s.insert(2, rng.choice(bad).format())
            sentences[0] = " ".join(s)
            cases.add(i)
        elif kind < 0.3:
            sentences = [rng.choice(errors)]
            cases.add(i)
        elif kind < 0.45:
            sentences.append(rng.choice(told).format(rng.randrange(9)))
        rows.append((i, f"d{i}", " ".join(sentences)))
        manifest.append((f"d{i}", (f"https://h{i % 12}.example/{i}", 200 if rng.random() < 0.8 else 404)))
    rows += [(n, "x", None), (n + 1, "y", ""), (n + 2, "z", "short but real")]
    c = spark.createDataFrame(rows, "capture_id bigint, capture_dir string, extracted_txt string").selectExpr("*", "1 as id", "2 as score")
    m = spark.createDataFrame(manifest, "capture_dir string, http struct<url:string,status_code:int>")
    return c, m, cases


def test_residue(spark):
    c, m, cases = captures(spark)
    rows = residue.residue_scores(c, m, "capture_id", "extracted_txt", "capture_dir").collect()
    got = {r["capture_id"] for r in rows if r["is_residue"]}
    assert len(rows) == 243
    assert len(got & cases) >= 0.95 * len(cases) and len(got - cases) <= 2
    assert next(r for r in rows if r["capture_id"] == 240)["score"] is None
    v = residue.validation(c, m, "capture_id", "extracted_txt", "capture_dir").collect()[0]
    assert v["unseen_hosts"] > 0 and v["precision"] > 0.8 and v["recall"] > 0.8


def test_residue_without_rows_or_cases(spark):
    c, m, _ = captures(spark, 3)
    assert residue.residue_scores(c.limit(0), m.limit(0), "capture_id", "extracted_txt", "capture_dir").count() == 0
    plain = c.where("capture_id >= 3")
    assert residue.residue_scores(plain, m.limit(0), "capture_id", "extracted_txt", "capture_dir").where("is_residue").count() == 0


def test_long_batches_are_worked_on_in_parts(monkeypatch):
    import numpy as np
    import pyarrow as pa

    texts = ["One two three.\nFour five. Six {{x}} seven.", None, "", "a " * 300, "- x\n- y\n- z\n1 | 2 | 3"] * 3
    b = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], names=["id", "text"])

    class Weights:
        value = np.random.default_rng(0).normal(size=residue.DIMENSIONS + 1)

    class Fitted:
        value = text_quality.fit([{"t": t * 4, "form": f} for t, f in zip([x for x in texts if x], ("prose", "junk", "list") * 3)], frozenset({"two"}))

    def run():
        return next(residue._score(iter([b]), Weights)).to_pylist(), next(text_quality._measure(iter([b]), frozenset({"two"}), Fitted)).to_pylist()

    want = run()
    monkeypatch.setattr(residue, "FLUSH", 5)
    monkeypatch.setattr(text_quality, "FLUSH", 2)
    got = run()
    for x, y in zip(want[0] + want[1], got[0] + got[1]):
        assert all((a is None and c is None) or abs(a - c) < 1e-6 for a, c in zip(x.values(), y.values()))


def test_status_is_a_soft_label():
    """A short text of a response that failed counts for either side; beside residue nothing is a negative."""
    assert residue.weak_label("Some words of no kind", 40, 404) is None and residue.weak_label("Some words of no kind", 40, 200) == 0 and residue.weak_label("Some words of no kind", 900, 404) == 0
    rows = [{"i": 1, "t": "Some words of no kind", "status": 404, "host": "h"}, {"i": 2, "t": "Page not found. Reference #12", "status": 404, "host": "h"}, {"i": 3, "t": "Plain words", "status": 200, "host": "h"}]
    x, y, weight, _ = residue.labelled(rows)
    assert sorted(y) == [0, 0, 1, 1] and weight.min() < residue.STATUS_WEIGHT < weight.max()


def test_places_are_exact_for_every_word():
    """As many spans as words, whatever composes, folds or has no width; each span holds its word."""
    for t in ("caf\u0065\u0301 \u200bx\u200b\u0301y ﬁn ＡＢ", "각가 각", "Σίσυφος ΟΔΟΣ İstanbul", "a\u00adb c\ud800d", "", "  ", "…½ x²"):
        spans = leaked_items.word_spans(t)
        assert len(spans) == len(words(t)) and all(a < b for a, b in spans)
        assert [words(t[a:b]) for a, b in spans] == [[w] for w in words(t)] or "Σ" in t
    rng = random.Random(3)
    for _ in range(2000):
        t = "".join(rng.choice("ab é\u0301\u200bＡﬁ각ᅡ각ς_-'²\ud800") for _ in range(9))
        assert len(leaked_items.word_spans(t)) == len(words(t)), ascii(t)


def test_phrases():
    for s in ("See {{#if version}} here", "Rates of <insert languages> rose", "Company: [name to be completed]", "lorem ipsum dolor", "You need to enable JavaScript to run this app.", "HTTP 404 - Page not found"):
        assert residue.weak_label(s, 400, 200) == 1, s
    for s in ("We write {train, test} for the pair of splits and [670] for the matching entry.", "Roughly 404 tokens were audited.", "Run export CORPUS=${HOME}/c first if you want to rebuild the counts."):
        assert residue.weak_label(s, 400, 200) == 0, s


# ---- text quality ----------------------------------------------------------------


def documents(spark):
    rng = random.Random(4)
    nouns, verbs = ["archive", "letter", "survey", "licence", "record", "page"], ["counted", "described", "removed", "kept", "sampled"]
    prose = lambda: f"The {rng.choice(nouns)} of the second {rng.choice(nouns)} was {rng.choice(verbs)} by {rng.randrange(90)} of the auditors, and the rest is to be {rng.choice(verbs)} in time."
    item = lambda: f"- {rng.choice(nouns).title()} {rng.choice('ABCDEF')}{rng.randrange(9)}"
    cell = lambda: " | ".join(str(rng.randrange(10_000)) for _ in range(5))
    noise = lambda: "".join(rng.choice("bcdfghjklmnpqrstvwxz ") for _ in range(160))
    rows, labels = [], []
    for i in range(160):
        form = ("prose", "list", "table", "junk")[i % 4]
        make = {"prose": prose, "list": item, "table": cell, "junk": noise}[form]
        rows.append((i, "\n".join(make() for _ in range(rng.randrange(4, 15)))))
        labels.append((i, form if i % 37 else "junk", "a"))
    rows += [(500, None), (501, ""), (502, " \n \n"), (503, "\n".join([prose() for _ in range(2)] + [cell() for _ in range(40)])), (504, prose() * 20_000)]
    labels += [(0, "table", "b"), (1, None, "c"), (2, "poem", "d")]
    d = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "'x' as form", "1 as id")
    return d, spark.createDataFrame(labels, "doc_id bigint, form string, reviewer string"), spark.createDataFrame([("en", w, 1) for w in ("the", "of", "and", "is", "to", "in", "by", "was", None)], "lang string, word string, pos int")


def test_text_quality(spark):
    d, labels, common = documents(spark)
    rows = {r["doc_id"]: r for r in text_quality.quality_statistics(d, labels, common, "doc_id", "text").collect()}
    right = sum(rows[i]["form"] == ("prose", "list", "table", "junk")[i % 4] for i in range(160))
    assert right >= 152
    assert rows[500]["form"] is None and rows[501]["n_words"] == 0 and rows[502]["n_lines"] == 0
    assert rows[503]["form"] == "table" and rows[504]["form"] == "prose"
    assert rows[0]["n_lines"] > 0 and 0 < rows[0]["common_word_share"] < 1 and rows[0]["lines_ending_in_punctuation"] == 1
    none = text_quality.quality_statistics(d, labels.limit(0), common.limit(0), "doc_id", "text")
    assert none.count() == len(rows)
    assert text_quality.quality_statistics(d.limit(0), labels, common, "doc_id", "text").count() == 0


# ---- packing -----------------------------------------------------------------------


def test_evolve_keeps_every_piece_and_capacity():
    rng = random.Random(2)
    for capacity in (10, 64, 100):
        sizes = [rng.randrange(1, capacity + 1) for _ in range(200)]
        genome = packing.evolve(sizes, capacity, 5, [])
        again = packing.evolve(sizes, capacity, 6, [genome])
        for g in (genome, again):
            load = {}
            for s, b in zip(sizes, g):
                load[b] = load.get(b, 0) + s
            assert len(g) == 200 and max(load.values()) <= capacity
        assert len(set(again)) <= len(set(genome)) <= 1.15 * -(-sum(sizes) // capacity) + 1


def test_crossover_makes_whole_solutions():
    import numpy as np

    rng = np.random.default_rng(1)
    sizes = rng.integers(1, 50, 120).tolist()
    one, two = packing._Bins(60), packing._Bins(60)
    one.best_fit(list(range(120)), sizes)
    two.best_fit(list(range(119, -1, -1)), sizes)
    child = packing._cross(one, two, sizes, rng)
    assert sorted(i for b in child.bins for i in b) == list(range(120))
    assert all(sum(sizes[i] for i in b) + f == 60 and f >= 0 for b, f in zip(child.bins, child.free))


def test_pack(spark):
    rng = random.Random(8)
    rows = [(k, "word " * rng.randrange(1, 400)) for k in range(120)] + [(900, None), (901, ""), (902, "big " * 5000), (7, "word again")]
    d = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "1 as pack_id", "'x' as id")
    packs = spark.createDataFrame([(1, 256), (2, 1024), (3, None), (4, 0)], "pack_id bigint, capacity_tokens bigint")
    tokens = packing.token_counts(d, "doc_id", "text")
    sums = {}
    for i, n in ((r["id"], r["n_tokens"]) for r in tokens.collect()):
        sums[i] = sums.get(i, 0) + n
    packed = packing.pack(d, packs, "doc_id", "text").cache()
    for p, capacity in ((1, 256), (2, 1024)):
        own = packed.where(f"pack_id = {p}").collect()
        load, parts = {}, {}
        for r in own:
            load[r["container"]] = load.get(r["container"], 0) + r["n_tokens"]
            parts.setdefault(r["doc_id"], []).append(r["n_tokens"])
        assert max(load.values()) <= capacity
        assert {i: sum(x) for i, x in parts.items()} == {i: n for i, n in sums.items() if n}
        assert all(len(x) == (2 if i == 7 else 1) for i, x in parts.items() if sums[i] <= capacity)
    assert {r["pack_id"] for r in packed.select("pack_id").distinct().collect()} == {1, 2}
    use = {r["pack_id"]: r for r in packing.usage(packed, packs).collect()}
    assert use[1]["unused_share"] < 0.05 and use[1]["fullest"] <= 256
    packed.unpersist()
    assert packing.pack(d.limit(0), packs, "doc_id", "text").count() == 0


def test_long_sentence_with_a_sign_is_scored_whole():
    """A phrase far from any sign counts, for one sign near the end."""
    s = "Please enable JavaScript and cookies in your browser to continue, or write to help@site.example"
    assert s in residue.units(s) and any("help@site" in u and "JavaScript" not in u for u in residue.units(s))
    w = np.zeros(residue.DIMENSIONS + 1, np.float32)
    w[zlib.crc32(b"javascript") & residue.DIMENSIONS - 1], w[-1] = 8, -4
    batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.array([s])], names=["id", "text"])
    (out,) = residue._score(iter([batch]), SimpleNamespace(value=w))
    assert out.column("score")[0].as_py() >= residue.THRESHOLD
    # it is learned from, too
    x, y, _, _ = residue.labelled([{"i": 1, "t": s, "status": 200, "host": "h"}])
    assert list(y) == [1] and len(x[0]) == len(residue.features(s, 0, len(s)))


def test_labelled_and_other_documents_share_the_sample(spark, monkeypatch):
    """However many labels there are, other documents and their lines are in the sample."""
    monkeypatch.setattr(text_quality, "SAMPLE_DOCUMENTS", 5)
    d = frame(spark, [(i, f"Line {i} of a text.\nAnd one more.") for i in range(40)], "doc_id long, text string")
    labels = frame(spark, [(i, "prose") for i in range(20)], "doc_id long, form string")
    assert sorted(r["form"] or "" for r in text_quality.sample(d, labels, "doc_id", "text")) == [""] * 5 + ["prose"] * 5
    monkeypatch.setattr(text_quality, "SAMPLE_LINES", 20)
    seen = []
    monkeypatch.setattr(text_quality, "Mixture", lambda x, form: seen.append(form) or SimpleNamespace(responsibilities=lambda x: np.ones((len(x), 1))))
    text_quality.fit([{"t": "A line of words.\n" * 50, "form": f} for f in ("prose", None)], frozenset())
    assert [(seen[0] == 0).sum(), (seen[0] < 0).sum()] == [20, 20]


def python_calls(run) -> int:
    """Calls that Python makes or is made to, a measure of time that does not depend on the machine."""
    n = 0

    def count(frame, event, arg):
        nonlocal n
        n += event in ("call", "c_call")

    sys.setprofile(count)
    try:
        run()
    finally:
        sys.setprofile(None)
    return n


def test_lines_are_measured_by_the_block():
    """Texts measured together have the statistics that each has alone, at a few calls a line, however many words it has."""
    odd = ["", " \n ", "bcdf", "ghj\nklm", "ΟΔΟΣ Σ.\rİİ İx 𝐀b 𝟙2\r\nⒶb ªc", "One two three four five\ngoes on; x | y   z ://", "x" * 9, "- A list\n- A list", "\x85a\x1cb  \x0b c"]
    rng = random.Random(5)
    texts = odd + ["\n".join(" ".join(rng.choice(["Word", "of", "12", "a|b"]) for _ in range(60)) for _ in range(8)) for _ in range(60)]
    common = frozenset({"of", "σ."})
    alone = [text_quality.line_statistics([t], common) for t in texts]
    together = text_quality.line_statistics(texts, common)
    for k in range(3):
        assert np.array_equal(together[k], np.concatenate([a[k] for a in alone]))
    assert np.bincount(together[3], minlength=len(texts)).tolist() == [len(a[0]) for a in alone]
    named = alone[4][0][:, 22] * alone[4][2][:, 0]
    assert named.tolist() == [1, 2, 0] and alone[5][2].tolist() == [[5, 0, 19], [7, 0, 14]]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], names=["id", "text"])
    run = lambda: list(text_quality._measure(iter([batch]), common, SimpleNamespace(value=None)))
    run()
    assert python_calls(run) < 25 * len(together[0])


def test_shares_are_those_of_the_gaussians():
    """Of the sums of powers come the means, covariances and densities as they are defined."""
    rng = np.random.default_rng(1)
    z, r = np.concatenate([rng.normal(k, 1 + k, (200, 3)) for k in range(2)]), rng.dirichlet([1, 1], 400)
    model = text_quality.Mixture.__new__(text_quality.Mixture)
    model._maximize(model._moments(z, lambda lo, hi, powers: r.T[:, lo:hi]), 3)
    want = []
    for w in r.T:
        c = z - np.average(z, 0, w)
        cov = (c * w[:, None]).T @ c / w.sum() + text_quality.RIDGE * np.eye(3)
        want.append(w.sum() / len(z) * np.exp(-0.5 * np.einsum("ni,ij,nj->n", c, np.linalg.inv(cov), c)) / np.sqrt(np.linalg.det(cov)))
    shares, log = model._shares(model._powers(z))
    assert np.allclose(shares, want / np.sum(want, 0)) and np.allclose(log, np.log(np.sum(want, 0)))


@given(st.lists(st.lists(st.sampled_from([*"aB1İ Ⅷσ{}[%(|_:/.\n", "404", " Name", " undefined ", " Todo", " of", " JS "]), max_size=90).map("".join) | st.text(max_size=40), max_size=6))
@settings(max_examples=80, deadline=None)
def test_scores_are_the_sums_of_features(texts):
    """Sentences scored together, by hashes put together from those of tokens, have the weights of their features."""
    texts = [t.encode("utf-8", "ignore").decode() for t in texts] + ["Of {{a}} the Name, [todo] " * 12, "…\n—", "", None]
    w = np.random.default_rng(3).normal(scale=0.05, size=residue.DIMENSIONS + 1)
    want = []
    for t in texts:
        parts = residue.sentences(t)
        chars = sum(map(len, parts))
        want.append(max((w[residue.features(u, k, chars)].sum() + w[-1] for k, s in enumerate(parts) for u in residue.units(s)), default=-30.0))
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], names=["id", "text"])
    (out,) = residue._score(iter([batch]), SimpleNamespace(value=w))
    *got, none = out.column("score").to_pylist()
    assert none is None and np.allclose(got, 1 / (1 + np.exp(-np.array(want[:-1]))), atol=1e-9)


def test_sentences_are_scored_at_few_calls():
    """The calls of Python do not grow with the n-grams."""
    rng = random.Random(5)
    texts = ["\n".join(" ".join(rng.choice(["Word", "of", "12", "a|b", "{x}"]) for _ in range(60)) for _ in range(8)) for _ in range(60)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], names=["id", "text"])
    run = lambda: list(residue._score(iter([batch]), SimpleNamespace(value=np.zeros(residue.DIMENSIONS + 1))))
    run()
    assert python_calls(run) < 120 * 8 * len(texts)
