"""Spelling variants, packed sequences and the manifest against brute force, the library and awkward rows."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from fixtures import SF, awkward, rows_of, with_clashes, words
from tokenizers import Tokenizer

from secflow.llm import manifest, packing, queries, spelling
from secflow.llm.common import table

# --- spelling -------------------------------------------------------------------------------------


def _one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def _variants(rng):
    """Words, their edits at both ends and in the middle, anagrams, accents and repeated letters."""
    stems = ["straßen", "éléphants", "abcdefgh", "aaaaaaaa", "ababababab", "gleichzeitig"]
    out = set(stems)
    for stem in stems:
        for _ in range(40):
            k, c = rng.randrange(len(stem)), rng.choice("abcéßÿxyz")
            out |= {stem[:k] + c + stem[k + 1:], stem[:k] + c + stem[k:], stem[:k] + stem[k + 1:], c + stem, stem + c}
        out.add("".join(rng.sample(stem, len(stem))))
    return sorted(w for w in out if len(w) >= 7)


def test_near_pairs_are_complete(spark):
    vocabulary = _variants(random.Random(5))
    got = spelling.near_pairs(spark.createDataFrame([(w, 2) for w in vocabulary], "word string, n long"))
    expected = {(a, b) for a in vocabulary for b in vocabulary if a < b and _one_edit(a, b)}
    pairs = [tuple(sorted((r.a, r.b))) for r in got.collect()]
    assert set(pairs) == expected and len(pairs) == len(expected) > 300


def test_spelling_by_hand(spark):
    """Counts, deletions by hash, ties of forms and chains of forms."""
    rng = random.Random(7)
    texts = ["straßen " * 300 + "Straßen " * 2, "straßes " * 20 + "Stroßes " * 2, "abcdefgh " * 30 + "abcdefgi " * 30,
             "abcdefgx " * 3, "ÀBCDEFGH " * 3, None, "", "short words only", " ".join(_variants(rng) * 2)]
    rows = [*enumerate(texts), (None, "straßen straßen"), (7, texts[-1])]
    got = {r.word: r for r in spelling.spelling(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    counts = Counter()
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for doc_id, text in rows:
        for run in "".join(c if c.isascii() and c.isalpha() or "À" <= c <= "ÿ" else " " for c in text or "").split():
            run = run.translate(lower)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            counts[run if h % 31 else run[:h % len(run)] + run[h % len(run) + 1:]] += 1
    counts = {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}
    near = {w: [x for x in counts if _one_edit(w, x)] for w in counts}
    forms = {}
    for w, others in near.items():
        best = min(others, key=lambda x: (-counts[x], x), default=None)
        forms[w] = best if best and counts[best] >= 10 * counts[w] else None
    for w, n in counts.items():
        root = w
        while forms[root]:
            root = forms[root]
        r = got.pop(w)
        assert (r.n, r.n_near, r.form, r.root, r.form_n) == (n, len(near[w]), forms[w], root, counts.get(forms[w]))
    assert not got and max(counts.values()) >= 290
    assert any(forms[w] and forms[forms[w]] for w in forms)  # straßen <- straßes <- stroßes


# --- packing --------------------------------------------------------------------------------------

ODD = ["It's <|endoftext|>x, İSTANBUL ﬁ éà ΑΣ'S", "a\x1cb c\x85d\xa0e　f", "don't 'sound we'LL 12 3,'re", "Straße!ÀÉ?",
       "x" * 300, "​́ ́", "<|STARTOFTEXT|> <|startoftext|>", "日本語 テキスト", " ", "ＦＵＬＬ ² ½"]


def _checked(spark, docs, capacity=packing.CAPACITY, **options):
    """Rows of the packing after checks of ids, cuts and places."""
    library = Tokenizer.from_file(queries.WORD_BPE)
    expected = Counter()
    for r in docs.select("doc_id", "text").collect():
        ids = np.array([*library.encode(r.text or "", add_special_tokens=False).ids, 1], "<u4")
        for k, start in enumerate(range(0, len(ids), capacity)):
            part = ids[start:start + capacity]
            expected[r.doc_id, k, start, len(part), zlib.crc32(part.tobytes())] += 1
    rows = packing.packed(docs, queries.WORD_BPE, capacity, **options).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == expected
    bins = defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    for places in bins.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= capacity
    total = sum(n[3] * times for n, times in expected.items())
    return rows, len(bins), -(-total // capacity)


def test_packing_equals_library(spark):
    extra = spark.createDataFrame(list(enumerate(ODD, 1000)), "doc_id long, text string")
    docs = awkward(spark).unionByName(table(spark, SF, "documents")).select("doc_id", "text").unionByName(extra)
    _, n, least = _checked(spark, docs)
    assert n <= least + 1
    _checked(spark, docs, capacity=50, task_rows=200)


def test_many_partitions_pack_as_few(spark):
    """Sorted lengths and many small tasks: residual rounds bring the sequences near those of one best fit of all."""
    rng = random.Random(1)
    texts = [words(rng, n, "a") for n in [130] * 400 + [40] * 400 + [3] * 300]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(16)
    rows, n, _ = _checked(spark, docs, capacity=512, task_rows=40)
    bins, _, _ = packing.best_fit(np.array([r.length for r in rows]), 512)
    assert n <= 1.03 * len(set(bins.tolist()))


def test_best_fit_by_plain_search():
    rng = np.random.default_rng(2)
    for capacity in (10, 97, 4096):
        sizes = rng.integers(1, capacity + 1, 300)
        bins, offsets, filled = packing.best_fit(sizes, capacity)
        held, homes = {}, {}
        for item in sorted(range(300), key=lambda k: -sizes[k]):
            room = [(capacity - held[b] - sizes[item], b) for b in held if held[b] + sizes[item] <= capacity]
            best = min(room)[0] if room else None
            assert (bins[item] == item) == (best is None)
            home = bins[item]
            assert best is None or capacity - held[home] - sizes[item] == best
            assert offsets[item] == held.get(home, 0)
            held[home] = held.get(home, 0) + sizes[item]
            homes[item] = home
        assert all(filled[k] == held[homes[k]] for k in homes)


# --- manifest -------------------------------------------------------------------------------------


def _h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _tree(nodes, arity):
    """Root of the nodes and, per leaf, the (before, after) siblings of each level."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for k, place in enumerate(at):
            run = place - place % arity
            paths[k].append((nodes[run:place], nodes[place + 1:run + arity]))
            at[k] = place // arity
        nodes = [_h(*nodes[k:k + arity]) for k in range(0, len(nodes), arity)]
    return nodes[0], paths


def _manifest(rows, arity=8):
    def leaf(r, text):
        fields = [r.doc_id, r.source, r.lang, r.n_chars, text]
        return _h(*["-" if f is None else f"{len(str(f).encode())}:{f}" for f in fields])

    langs = defaultdict(list)
    for r in rows:
        langs[r.lang].append((-1 if r.doc_id is None else r.doc_id, leaf(r, r.text), r))
    order = sorted(langs, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for lang in order:
        langs[lang].sort(key=lambda x: x[:2])
        trees[lang] = _tree([x[1] for x in langs[lang]], arity)
    root, tops = _tree([trees[lang][0] for lang in order], arity)
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    out = []
    for lang, top in zip(order, tops):
        subroot, paths = trees[lang]
        for (_, d, r), path in zip(langs[lang], paths):
            hit = r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 0
            folded = leaf(r, r.text.translate(lower) if hit and r.text is not None else r.text)
            for before, after in path + top:
                folded = _h(*before, folded, *after)
            proof = _h(*[x for before, after in path + top for x in before + after])
            out.append((r.doc_id, d, subroot, root, proof, folded, folded == root))
    return sorted(out, key=str)


@pytest.mark.parametrize("arity", [2, 3, 8])
def test_manifest_by_plain_trees(spark, arity):
    docs = awkward(spark).unionByName(table(spark, SF, "documents").select("doc_id", "text", "lang", "source", "n_chars"))
    got = rows_of(manifest.manifest(docs, arity))
    assert got == _manifest(docs.collect(), arity)
    assert {r[-1] for r in got} == {True, False}


@pytest.mark.parametrize("where", ["doc_id = 1", "doc_id IN (1, 2)", "doc_id IN (2, 7)", "doc_id IS NULL"])
def test_small_manifests(spark, where):
    docs = awkward(spark).where(where)
    assert rows_of(manifest.manifest(docs)) == _manifest(docs.collect())


def test_many_languages(spark):
    """Languages of one row each and a hot one: the upper tree has levels of its own."""
    docs = spark.range(150).selectExpr(
        "id AS doc_id", "concat('Text ', id) AS text", "CASE WHEN id % 3 = 0 THEN 'a' ELSE concat('é', id) END AS lang",
        "'s' AS source", "7 AS n_chars")
    assert rows_of(manifest.manifest(docs)) == _manifest(docs.collect())


# --- awkward rows ---------------------------------------------------------------------------------

OPERATORS = {
    "spelling": spelling.spelling, "manifest": manifest.manifest,
    "packing": lambda d: packing.packed(d, queries.WORD_BPE).drop("sequence_id", "offset")}


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_awkward(spark, name):
    docs = awkward(spark)
    got = rows_of(OPERATORS[name](docs))
    more = ["grp", "idx", "d", "place", "first", "steps", "word", "bin", "offset", "filled", "length", "id", "run", "lang_"]
    clashing = with_clashes(docs).selectExpr("*", *[f"7 AS `{c}`" for c in more])
    assert rows_of(OPERATORS[name](clashing)) == got
    assert OPERATORS[name](docs.where("false")).count() == 0
    if name != "spelling":
        assert len({r[0] for r in got}) == docs.select("doc_id").distinct().count()
