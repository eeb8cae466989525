"""Results against brute force, the library, exact round trips and held-out accuracy."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from fixtures import SF, awkward, words
from tokenizers import Tokenizer

from secflow.llm import (
    coder, decontamination, language, mixing, near_duplicates, personal, queries, rules, token_files, tokens, toxicity,
    wrappers)
from secflow.llm.common import shared_path, table

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _docs(spark):
    return awkward(spark).unionByName(table(spark, SF, "documents"))


# --- personal data --------------------------------------------------------------------------------

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def _valid(kind, x):
    digits = [int(c) for c in x if c.isdigit()]
    if kind == "ip":
        return all(int(p) <= 255 for p in x.split("."))
    if kind == "card":
        total = sum(d if k % 2 == 0 else d * 2 - 9 * (d > 4) for k, d in enumerate(reversed(digits)))
        return 12 <= len(digits) <= 19 and total % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def test_base_spans(spark):
    extra = [
        "a@b.c_d@e.f x@y", "1.2.3.4.5.6.7.8 256.1.1.1 001.2.3.4", "4111 1111 1111 1111 4111-1111-1111-1111",
        "+49 (30) 1234567 +1", "++1234567890", "é😀 a.b@c.de, 10.0.0.1", "1" * 3000, "1 " * 3000, "x" * 5000 + "@y.z"]
    docs = _docs(spark).select("doc_id", "text").unionByName(
        spark.createDataFrame([(10_000 + k, t) for k, t in enumerate(extra)], "doc_id long, text string"))
    expected = Counter()
    for r in docs.collect():
        spans = sorted(
            (m.start(), k, m.end()) for k, (kind, p) in enumerate(BASE.items())
            for m in re.finditer(p, r.text or "") if _valid(kind, m[0]))
        text = ",".join(f"{list(BASE)[k]}:{a}:{b}" for a, k, b in spans)
        expected[r.doc_id, hashlib.sha256(text.encode()).hexdigest()] += 1
    assert Counter((r.doc_id, r.base_sha256) for r in personal.personal_data(docs).collect()) == expected


def test_contexts_find_more(spark):
    """A context that precedes many cards marks a number that fails the check; a rarer one does not."""
    cards = ["4111111111111111", "5500005555555559", "340000000000009", "30000000000004", "6011000000000004"]
    rows = [(k, f"please pay with card {c} today") for k, c in enumerate(cards)]
    rows += [(20, "pay with card 4111111111111112 soon"), (21, "order number was 4111111111111112"), (22, "with card 12")]
    got = {r.doc_id: r for r in personal.personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[20].spans == "card:14:30" and got[20].n_card == 0 and got[20].n_learnt == 1
    assert got[21].spans == "" and got[22].spans == ""
    assert all(got[k].n_card == 1 and got[k].spans.startswith("card:21:") for k in range(5))


# --- tokens ---------------------------------------------------------------------------------------


@pytest.mark.parametrize("limit", [4_000_000, 15])
def test_units_equal_library(limit):
    rng = random.Random(1)
    parts = ["a", "b", " ", "  ", "\n", "\t", " \n", "\xa0", "1", "23", "'s", "'ll", "<|endoftext|>", "é", "ß", ",", ".",
             "!!", "$", "　", "\x1f", "日本", "x,", "y. ", "\r\n", "​", "🎉", "word,", "\x85"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 40))) for _ in range(5000)]
    plain = [e.ids for e in Tokenizer.from_file(queries.BYTE_BPE).encode_batch(texts, add_special_tokens=False)]
    assert tokens.Vocabulary(queries.BYTE_BPE).encode_all(texts, limit) == [len(x) for x in plain]
    small = tokens.Vocabulary(queries.BYTE_BPE, ids=True, kept=50)  # starts anew again and again
    assert small.encode_all(texts, limit) == [np.array(x, "<u4").tobytes() for x in plain]


def test_other_vocabularies(spark):
    import public_tokenizers
    import sentencepiece

    docs = table(spark, SF, "documents").limit(40)
    texts = {r.doc_id: r.text for r in docs.collect()}
    piece = public_tokenizers.path("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=piece)
    for r in tokens.token_counts(docs, piece).collect():
        assert r.n_tokens == len(model.encode(texts[r.doc_id])) and r.n_bytes == len(texts[r.doc_id].encode())
    word = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(word)
    for r in tokens.token_counts(docs, word).collect():
        assert r.n_tokens == len(library.encode(texts[r.doc_id], add_special_tokens=False).ids)


@pytest.mark.parametrize("block", [1, 300, 4096])
def test_coder_round_trip(block):
    rng = np.random.default_rng(1)
    for ids in ([5], np.arange(900) % 7, rng.integers(0, 50257, 3000), rng.zipf(1.3, 3000) % 100_000, rng.integers(0, 2**32, 700)):
        ids = np.asarray(ids, np.uint32)
        blocks = coder.encode_blocks(ids[:600] if block == 1 else ids, block)
        assert (np.concatenate(coder.decode_blocks(blocks)) == (ids[:600] if block == 1 else ids)).all()
    assert coder.encode_blocks(np.zeros(0, np.uint32)) == []


def test_coder_is_adaptive_and_checked():
    repeated = np.tile(np.arange(40), 100)
    blocks = coder.encode_blocks(repeated)
    assert sum(map(len, blocks)) < len(repeated) / 8
    for at in (0, 9, 40, len(blocks[0]) - 1):
        bad = bytearray(blocks[0])
        bad[at] ^= 1
        with pytest.raises(coder.CorruptBlock):
            coder.decode_blocks([bytes(bad)])
    with pytest.raises(coder.CorruptBlock):
        coder.decode_blocks([blocks[0][:10]])


def test_token_files(spark):
    docs = _docs(spark)
    folder = shared_path(spark, "tokens")
    token_files.write_tokens(docs, folder, queries.BYTE_BPE, partitions=3, segment_ids=20_000)
    got = sorted(token_files.read_tokens(spark, folder, with_ids=True).collect(), key=lambda r: r.start)
    keys = [(r.doc_id is not None, r.doc_id or 0) for r in got]
    assert keys == sorted(keys)
    library, at = Tokenizer.from_file(queries.BYTE_BPE), 0
    known = Counter()
    for r in docs.collect():
        known[r.doc_id, tuple(library.encode(r.text or "", add_special_tokens=False).ids + [2])] += 1
    for r in got:
        assert r.start == at and r.n_tokens == len(r.ids)
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        at += r.n_tokens
    assert Counter((r.doc_id, tuple(r.ids)) for r in got) == known


def test_last_segment_is_not_small(spark):
    docs = spark.createDataFrame([(k, f"a b c {k}") for k in range(600)], "doc_id long, text string")
    folder = shared_path(spark, "tokens")
    token_files.write_tokens(docs, folder, queries.BYTE_BPE, partitions=1)
    ids = sum(r.n_ids for r in spark.read.parquet(folder).collect())
    for share, most in ((0.9, 1), (0.3, 3)):
        folder = shared_path(spark, "tokens")
        token_files.write_tokens(docs, folder, queries.BYTE_BPE, partitions=1, segment_ids=int(ids * share))
        sizes = [r.n_ids for r in spark.read.parquet(folder).collect()]
        assert len(sizes) == most and min(sizes) >= int(ids * share) // 2 and sum(sizes) == ids
        assert [r.start for r in token_files.read_tokens(spark, folder).orderBy("doc_id").limit(2).collect()][0] == 0
        assert token_files.read_tokens(spark, folder).count() == 600


def test_common_units_stay_known():
    held = tokens.Vocabulary(queries.BYTE_BPE, ids=True, kept=200)
    asked = Counter()

    class Counted:
        def encode_batch_fast(self, texts, **options):
            asked["common"] += sum(t.count("commonplace") for t in texts)
            return library.encode_batch_fast(texts, **options)

    library, held.tokenizer = held.tokenizer, Counted()
    common = [f"commonplace{k}" for k in range(20)]
    for turn in range(40):
        texts = [" ".join(["x", *common, *[f"rare{turn}y{k}," for k in range(30)]]), f"a\n{common[0]} it's {common[1]}.", "", "\n b"]
        expected = [np.array(library.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
        assert held.encode_all(texts) == expected
    assert asked["common"] <= 25
    assert len(held.after_blank) <= 200


# --- mixing ---------------------------------------------------------------------------------------


def _targets(sizes, weights, share=1.5, epochs=2.0):
    budget, clamped = share * sum(sizes), set()
    while True:
        rest = budget - sum(epochs * sizes[k] for k in clamped)
        total = sum(w for k, w in enumerate(weights) if k not in clamped)
        new = {k for k, w in enumerate(weights) if k not in clamped and rest * w / total > epochs * sizes[k]}
        if not new:
            return [epochs * s if k in clamped else rest * weights[k] / total for k, s in enumerate(sizes)]
        clamped |= new


def test_mixture(spark):
    docs = _docs(spark)
    rows = mixing.mixed(docs).collect()
    size = {}
    for r in docs.collect():
        size[r.source] = size.get(r.source, 0) + len(WORD.findall(r.text or ""))
    order = sorted(size, key=lambda s: (s is None, s or ""))
    expected = dict(zip(order, _targets([size[s] for s in order], [(5, 2, 1)[k % 3] for k in range(len(order))]), strict=True))
    taken = Counter()
    for r in rows:
        assert r.size == len(WORD.findall(r.text or "")) and r.source_size == size[r.source]
        assert abs(r.target - expected[r.source]) < 1e-6 and 0 <= r.taken <= 2 * r.size
        taken[r.source] += r.taken
    assert len(rows) == docs.count()
    for s in order:
        assert abs(taken[s] - expected[s]) <= 3
    again = mixing.mixed(docs.repartition(5)).select("doc_id", "text", "taken").collect()
    assert Counter(map(tuple, again)) == Counter((r.doc_id, r.text, r.taken) for r in rows)


def test_repetitions(spark):
    docs = _docs(spark)
    taken = sum(r.taken for r in mixing.mixed(docs).collect())
    copies = mixing.repeated(docs).collect()
    assert sum(len(WORD.findall(r.text)) for r in copies) == taken
    assert all(r.n_chars == len(r.text) for r in copies)


# --- language and toxicity ------------------------------------------------------------------------


def test_language(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    lang = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    held = [r for r in language.identify(docs).collect() if r.held_out]
    assert sum(lang[r.doc_id] == r.lang_pred for r in held) >= 0.99 * len(held)
    assert sum(r.rejected for r in held) <= 0.01 * len(held) and all(0 <= r.score <= 1 for r in held)
    assert {r.held_out for r in language.identify(docs.where("crc32(cast(doc_id as string)) % 4 = 2")).collect()} == {True}


def test_language_models_are_distributions():
    import pandas as pd

    model = language.train(pd.DataFrame({"lang": "x", "gram": language._grams(language.classes("abc abd abc bca"), 3), "n": 1}).groupby(
        ["lang", "gram"], as_index=False).sum())
    context = language._grams(language.classes("abc"), 3)[1] >> language.CLASS_BITS
    every = np.arange(1 << language.CLASS_BITS) | context << language.CLASS_BITS
    at = model.places[every]
    chance = np.where(at >= 0, model.logp[at, 0], (model.lower[every & 0x3FFF, 0] + model.backoff[context, 0]))
    assert abs(np.exp(chance).sum() - 1) < 1e-5


def test_toxicity_gradients():
    rng = np.random.default_rng(0)
    held = toxicity.Words()
    _, grid = toxicity.windows(held.number([[f"w{rng.integers(0, 30)}" for _ in range(n)] for n in (40, 20, 33)]))
    p = {k: v.astype(np.float64) for k, v in toxicity.new_params(rng).items()}
    labels, weights = (np.arange(len(grid)) % 2).astype(float), np.ones(len(grid))
    _, g = toxicity.gradients(grid, labels, weights, held, p)
    for name, x in g.items():
        at = np.unravel_index(np.argmax(np.abs(x)), x.shape)
        value, sides = p[name][at], []
        for move in (1e-2, -1e-2):
            p[name][at] = value + move
            sides.append(toxicity.gradients(grid, labels, weights, held, p)[0])
        p[name][at] = value
        assert abs((sides[0] - sides[1]) / 2e-2 - x[at]) < 1e-3 * max(1, abs(x[at]))


@pytest.mark.parametrize("n", [64, 65, 112, 113, 1000])
def test_toxicity_reads_whole_runs(n):
    run = "".join(random.Random(n).choice("abcdefgh字") for _ in range(n))
    pieces = toxicity.words_of(run)
    assert max(map(len, pieces)) <= 64 and pieces[0] + "".join(x[16:] for x in pieces[1:]) == run
    flat, other = (set(toxicity.char_rows(toxicity.words_of(x))[0].tolist()) for x in (run, run[:-8] + "x" * 8))
    assert flat != other


def test_toxicity_finds_words_anywhere(spark):
    rng = random.Random(5)
    rows, labels = [], []
    for k in range(400):
        text, bad = words(rng, rng.choice([5, 60, 300])).split(" "), k % 3 == 0
        if bad:
            text.insert(rng.randrange(len(text) + 1), rng.choice(["vile", "rotten", "filthy"]))
        rows.append((k, " ".join(text)))
        labels.append((k, 1, int(bad)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = toxicity.toxicity(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    held = [r for r in got if r.held_out]
    assert len(held) > 50 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got)
    assert sum(r.predicted == (r.doc_id % 3 == 0) for r in held) >= 0.95 * len(held)


# --- near-duplicates ------------------------------------------------------------------------------


def _classes(texts):
    sets = {}
    for k, t in texts.items():
        w = WORD.findall(t)
        sets[k] = {tuple(w[i:i + 5]) for i in range(max(len(w) - 4, 1))} if w else set()
    label = {k: k for k in texts}
    changed = True
    while changed:
        changed = False
        for a in texts:
            for b in texts:
                common = len(sets[a] & sets[b])
                same = texts[a] == texts[b] or (common and common >= 0.8 * len(sets[a] | sets[b]))
                if a < b and same and label[a] != label[b]:
                    low = min(label[a], label[b])
                    label[a] = label[b] = low
                    changed = True
    return label


def test_near_duplicates(spark):
    rng = random.Random(9)
    texts, k = {}, 0
    for _ in range(12):
        base = words(rng, rng.choice([6, 40, 300])).split(" ")
        for _ in range(rng.choice([1, 2, 8])):
            copy = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 6])):
                copy[rng.randrange(len(copy))] = f"n{rng.randrange(1000)}"
            texts[k], k = " ".join(copy), k + 1
    texts |= {k: "one two", k + 1: "one  two", k + 2: "", k + 3: "", k + 4: "one"}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: r.class_id for r in near_duplicates.near_duplicates(docs).collect()}
    assert got == _classes(texts)
    kept = {r.doc_id for r in near_duplicates.deduplicated(docs).collect()}
    assert kept == set(got.values())


def _linked(spark, texts, bands):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = [(hashlib.md5(t.encode()).hexdigest(), len(t.split()) - 4, b) for t, b in zip(texts, bands, strict=True)]
    found = near_duplicates.links(docs, spark.createDataFrame(rows, "th string, n long, bands array<long>"))
    label = {r.node: r.label for r in near_duplicates.components(found).collect()}
    return [label.get(r[0]) for r in rows]


def test_linked_members_meet_the_rejected(spark):
    for stem in range(50):  # an end of the chain is the pivot
        texts = [" ".join(f"{stem}w{i}" for i in range(a, a + 104)) for a in (0, 10, 20)]
        names = [hashlib.md5(t.encode()).hexdigest() for t in texts]
        if max(names) == names[0]:
            break
    labels = _linked(spark, texts, [list(range(40))] * 3)
    assert labels[0] is not None and len(set(labels)) == 1


def test_no_pair_of_a_bucket_is_lost(spark):
    texts = [" ".join(f"{k}w{i}" for i in range(a, a + 104)) for k in range(12) for a in (0, 10)]
    labels = _linked(spark, texts, [[1, *(1000 * k + b for b in range(1, 40))] for k in range(24)])
    assert None not in labels and len(set(labels)) == 12
    assert all(labels[2 * k] == labels[2 * k + 1] for k in range(12))


def test_repeated_rows_leave_one(spark):
    docs = spark.createDataFrame(
        [(1, "a b c d e f", 1), (1, "a b c d e f", 2), (2, "a b c d e f", 3), (None, "a b c d e f", 4), (None, "x", 5), (None, "x", 6),
         (3, None, 7), (3, None, 8)], "doc_id long, text string, other int")
    got = near_duplicates.deduplicated(docs).collect()
    assert Counter((r.doc_id, r.text) for r in got) == Counter({(1, "a b c d e f"): 1, (None, "x"): 1, (3, None): 2})


def test_signature_estimates_similarity():
    one, two = list(range(300)), list(range(60, 360))
    texts = [" ".join(map(str, x)).encode() for x in (one, two)]
    owner, hashes, counts = near_duplicates.shingles(texts)
    sign = near_duplicates.signatures(owner, hashes, counts, 2, m=4096)
    a, b = (set(hashes[owner == k]) for k in (0, 1))
    assert abs((sign[0] == sign[1]).mean() - len(a & b) / len(a | b)) < 0.03


def test_components_long_chain(spark):
    edges = spark.createDataFrame([(f"{k:03}", f"{k + 1:03}") for k in range(40)] + [("500", "501")], "a string, b string")
    labels = {r.node: r.label for r in near_duplicates.components(edges).collect()}
    assert labels == {f"{k:03}": "000" for k in range(41)} | {"500": "500", "501": "500"}


# --- pages ----------------------------------------------------------------------------------------


def test_main_text():
    page = (
        '<body><div id="cookie-notice">We use cookies</div><header><h1>Site</h1></header><div class="content"><h2>T&eacute;st</h2>'
        '<p>One  <i>two</i>\n three<p>Four &amp; five<div class="ad">Buy</div><ul><li>a<li>b</ul><form>x</form>'
        '<section class="comments"><p>nice</p></section><script>var x = "</p>";</script></div><footer>f</footer>')
    places = set(wrappers.article_places(wrappers.skeleton(page).split("\n")))
    assert wrappers.extract(page, places) == "Tést\nOne two three\nFour & five\na\nb"


def test_templates_of_one_host(spark):
    pages = ["<article><p>one</p></article>", "<div class=post><p>two</p></div>", "<div id=text><p>three</p></div>"]
    rows = [(k, url, p) for url in ("http://h/x", None) for k, p in enumerate(pages)]
    got = wrappers.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert sorted(r.text for r in got) == ["one", "one", "three", "three", "two", "two"]


def test_alignment_is_union_free():
    one, two = ["a", "b+", "c"], ["a", "b", "d", "c", "c"]
    assert wrappers.align(one, two) == ["a", "b+", "d?", "c+"]
    assert wrappers.align(wrappers.align(one, two), ["a"]) == ["a", "b+?", "d?", "c+?"]


def test_hosts_beyond_one_task(spark, monkeypatch):
    monkeypatch.setattr(wrappers, "ALIGN_AT_ONCE", 3)
    html = "<nav>menu</nav><article>{}</article>"
    rows = [(k, f"http://h{k % 2}/{k}", html.format("".join(f"<h{k % 6 + 1}>t{k}</h{k % 6 + 1}><p>x</p>" for _ in range(1 + k % 4)))) for k in range(60)]
    got = wrappers.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert all(r.text == "\n".join([f"t{r.page_id}", "x"] * (1 + r.page_id % 4)) for r in got)


# --- rules and decontamination --------------------------------------------------------------------


def test_host_verdict(spark):
    good = " ".join(f"w{k}" for k in range(60))
    rows = [(k, "short", "bad") for k in range(90)] + [(100 + k, f"{good} {k}", "bad") for k in range(10)]
    rows += [(200 + k, f"{good} {k}", s) for k in range(300) for s in ("good",)] + [(600, f"{good} z", "small"), (601, "short", "small")]
    got = {r.doc_id: r for r in rules.quality(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert not any(got[100 + k].kept or got[100 + k].base_failed for k in range(10))
    assert all(got[200 + k].kept for k in range(300)) and got[600].kept and not got[601].kept


def _hits(doc, items):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", doc.translate({c: c + 32 for c in range(65, 91)}))
    covered, found = set(), set()
    for item, text in items:
        t = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
        size = min(13, len(t))
        for s in range(len(t) - size + 1) if t else ():
            for at in range(len(w) - size + 1):
                if w[at:at + size] == t[s:s + size]:
                    covered |= set(range(at, at + size))
                    found.add(str(item))
    return len(w), len(covered), sorted(found)


def test_contamination(spark):
    rng = random.Random(4)
    items = [(k, words(rng, n, "i")) for k, n in enumerate([30, 13, 14, 5, 1, 3, 40])] + [(50, None), (51, " ,;"), (52, "É a"), (10, words(rng, 20, "i"))]
    docs = []
    for k in range(60):
        text = words(rng, rng.choice([0, 5, 90]))
        item = rng.choice(items)[1] or ""
        cut = item.split(" ")
        a = rng.randrange(max(len(cut) - 12, 1))
        docs.append((k, f"{text} {' '.join(cut[a:a + rng.choice([4, 12, 13, 20])]).upper()}, {words(rng, 3)}"))
    docs += [(100, None), (101, ""), (102, "É A"), (103, "é a")]
    got = decontamination.contamination(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    for r in got.collect():
        n, hit, found = _hits(dict(docs)[r.doc_id] or "", items)
        assert (r.n_words, r.n_hit, r.n_items) == (n, hit, len(found)), r
        assert r.items_sha256 == hashlib.sha256(",".join(found).encode()).hexdigest()
        assert r.contaminated == (hit > 0 and 20 * hit >= n)
