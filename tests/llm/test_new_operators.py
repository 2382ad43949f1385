"""Spelling variants, Merkle manifest and licence scan against brute force and hand-made edge cases."""

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from farebox.llm import licenses, merkle, queries, spelling

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


def written(docs, folder):
    """A table folder that a registered query can read."""
    docs.write.parquet(f"{folder}/documents.parquet")
    return str(folder)


def edge_documents(spark):
    """NULLs everywhere, empty and long texts, repeated rows and ids, and a column that no operator knows."""
    rows = [
        (None, None, None, None, None), (1, None, "en", "a", 0), (2, "", "en", "a", 0), (3, "Same text, MIT License.", "en", "a", 1),
        (3, "Same text, MIT License.", "en", "a", 1), (3, "Other text\nwith the same id", "en", "a", 2),
        (None, "Same text, MIT License.", "en", None, 2), (None, "Apache\nLicense", None, "", None),
        (5, "wonderful " * 30_000 + "cc by", "en", "b", 9), (6, "x" * 90_000, "en", "b", 9), (7, "\n\n", "en", "ü", 2),
    ]
    return spark.createDataFrame(rows, DOCUMENTS).withColumn("label.of.it", F.lit(1))


# ---- 11 spelling variants ----

def one_edit(a, b):
    """Whether exactly one letter has to be inserted, deleted or replaced."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    return a[i + 1:] == b[i + 1:] if len(a) == len(b) else a[i:] == b[i + 1:]


def plain_groups(counts, ratio):
    near = {w: [v for v in counts if one_edit(w, v)] for w in counts}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-counts[v], v.encode()), default=None)
        form[w] = best if best is not None and counts[best] >= ratio * counts[w] else None
    out = []
    for w in counts:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, counts[w], form[w], counts[form[w]] if form[w] else None, root, len(near[w])))
    return sorted(out, key=repr)


def groups(spark, counts, **options):
    words = spark.createDataFrame(list(counts.items()), "word string, n long").withColumn("n_near", F.lit("clash"))
    return sorted((tuple(r) for r in spelling.variant_groups(words, **options).collect()), key=repr)


@pytest.mark.parametrize("letters, longest, unit_size", [("ab", 6, 4096), ("ab", 9, 3), ("abcé", 4, 5), ("ab", 14, 40)])
def test_spelling_brute_force(spark, letters, longest, unit_size):
    rng = random.Random(longest)
    words = {"".join(rng.choice(letters) for _ in range(rng.randint(1, longest))) for _ in range(220)}
    counts = {w: int(10 ** rng.uniform(0, 4)) for w in words}
    assert groups(spark, counts, unit_size=unit_size) == plain_groups(counts, 10)
    assert groups(spark, counts, unit_size=unit_size, ratio=2) == plain_groups(counts, 2)


def test_spelling_crowded_units_and_chains(spark):
    # thousands of words share a half, so units have to be cut; each link of the chain is ten times as frequent
    rng = random.Random(3)
    counts = {f"verylong{''.join(rng.choice('abcdefgh') for _ in range(4))}": rng.randint(2, 500) for _ in range(1500)}
    chain = ["prefixaaaa", "prefixaaab", "prefixaabb", "prefixabbb", "prefixbbbb"]
    counts |= {w: 2 * 10 ** i for i, w in enumerate(chain)}
    found = groups(spark, counts, unit_size=50)
    assert found == plain_groups(counts, 10)
    assert {r[4] for r in found if r[0] in chain} == {"prefixbbbb"}


def test_spelling_position_index():
    rng = random.Random(8)
    words = sorted({"".join(rng.choice("abc") for _ in range(rng.randint(4, 5))) for _ in range(150)})
    index = spelling.PositionIndex(words, 4)
    for w in words:
        wanted = [v for v in words if one_edit(w, v) and min(len(w), len(v)) == 4]
        assert [v for i, v in enumerate(words) if index.near(w) >> i & 1] == wanted
        apart = [v for v in wanted if v[:2] != w[:2]]
        assert [v for i, v in enumerate(words) if index.near(w, 2) >> i & 1] == apart


def test_spelling_edge_words(spark):
    words = [("wonder", 3), ("wonder", 4), (None, 5), ("", 5), ("wonders", 70), ("x" * 5000, 2), ("x" * 5001, 20), ("wönder", 1)]
    table = spark.createDataFrame(words, "word string, n long")
    counts = {"wonder": 7, "wonders": 70, "x" * 5000: 2, "x" * 5001: 20, "wönder": 1}
    assert sorted((tuple(r) for r in spelling.variant_groups(table).collect()), key=repr) == plain_groups(counts, 10)
    assert spelling.variant_groups(table.limit(0)).count() == 0
    tied = {"tastier": 100, "tastiee": 100, "tastie": 5}
    assert [r[2] for r in groups(spark, tied) if r[0] == "tastie"] == ["tastiee"]
    with pytest.raises(ValueError):
        spelling.variant_groups(table, ratio=1)


def test_spelling_query_on_edge_rows(spark, tmp_path):
    docs = edge_documents(spark)
    counts = {}
    for row in docs.collect():
        for run in re.findall("[A-Za-zÀ-ÿ]+", row.text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if row.doc_id is None else row.doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] = counts.get(run, 0) + 1
    counts = {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}
    assert counts
    out = queries.QUERIES["op11_spelling_variants"](spark, written(docs, tmp_path / "t"))
    assert sorted((tuple(r) for r in out.select("word", "n", "form", "form_n", "root", "n_near").collect()), key=repr) == plain_groups(counts, 10)
    empty = queries.QUERIES["op11_spelling_variants"](spark, written(docs.limit(0), tmp_path / "e"))
    assert empty.count() == 0


# ---- 12 Merkle manifest ----

def plain_leaf(values):
    parts = ["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values]
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_tree(leaves):
    """(root, per leaf the siblings' digests as (left, right) per level)."""
    level, at, ways = list(leaves), list(range(len(leaves))), [[] for _ in leaves]
    while len(level) > 1:
        for i, place in enumerate(at):
            first = place - place % 3
            ways[i].append(("".join(level[first:place]), "".join(level[place + 1:first + 3])))
        level = [hashlib.sha256("".join(level[i:i + 3]).encode()).hexdigest() for i in range(0, len(level), 3)]
        at = [p // 3 for p in at]
    return level[0], ways


def plain_manifest(rows, tampered):
    """Rows are (group, key, values); tampered gives the values to try. -> sorted result rows."""
    groups_of = {}
    for row in rows:
        groups_of.setdefault(row[0], []).append(row)
    order = sorted(groups_of, key=lambda g: (g is not None, (g or "").encode()))
    built = []
    for g in order:
        members = sorted(((k, plain_leaf(v), plain_leaf(tampered(v))) for _, k, v in groups_of[g]), key=lambda m: (m[0] is not None, m[0] or 0, m[1], m[2]))
        root, ways = plain_tree([m[1] for m in members])
        built.append((members, root, ways))
    root, upper = plain_tree([b[1] for b in built])
    out = []
    for (members, subroot, ways), above in zip(built, upper):
        for (key, leaf, changed), way in zip(members, ways):
            folded = changed
            for left, right in way + above:
                folded = hashlib.sha256((left + folded + right).encode()).hexdigest()
            proof = hashlib.sha256("".join(x for both in way + above for x in both).encode()).hexdigest()
            out.append((key, leaf, subroot, root, proof, folded, folded == root))
    return sorted(out, key=repr)


@pytest.mark.parametrize("sizes", [[1], [2], [3], [4, 1], [9, 10, 26, 27, 28, 1], [2187, 2188, 1, 700], [1] * 40])
def test_manifest_brute_force(spark, sizes):
    rng = random.Random(len(sizes))
    rows = [(None if g == 1 else f"s{g}", 10 * k + g, [10 * k + g, rng.choice(["a", "", None, "x\ny", "ü\n"])]) for g, n in enumerate(sizes) for k in range(n)]

    def tampered(values):
        return [values[0], values[1].replace("\n", "") if values[1] and values[0] % 2 else values[1]]

    table = spark.createDataFrame([(g, k, v[1]) for g, k, v in rows], "grp string, size long, digest string")
    try_ = F.when(F.col("size") % 2 == 1, F.replace("digest", F.lit("\n"), F.lit(""))).otherwise(F.col("digest"))
    manifest = merkle.build(table, [F.col("size"), F.col("digest")], F.col("size"), F.col("grp"), [F.col("size"), try_])
    found = merkle.prove(manifest, whole=False)
    wanted = plain_manifest(rows, tampered)
    assert sorted((tuple(r) for r in found.collect()), key=repr) == wanted
    if len(sizes) < 5:
        whole = merkle.prove(manifest).collect()
        for row in whole:
            way = [(step.left, step.right) for step in row.proof]
            assert merkle.fold(row.leaf, way) == row.root == manifest.root
            assert merkle.proof_digest(way) in {w[4] for w in wanted if w[0] == row.key}


def test_manifest_over_several_layers(spark, monkeypatch):
    # blocks of nine nodes, so that 700 leaves need three layers, the groups two
    monkeypatch.setattr(merkle, "LEVELS", 2)
    monkeypatch.setattr(merkle, "BLOCK", 9)
    rows = [(f"s{k % 4 if k % 2 else 0}", k, [k, f"text {k}\n" if k % 3 else "plain"]) for k in range(700)]
    rows += [(f"t{k}", 1000 + k, [1000 + k, "one"]) for k in range(20)]

    def tampered(values):
        return [values[0], values[1].replace("\n", "")]

    table = spark.createDataFrame([(g, k, v[1]) for g, k, v in rows], "source string, id long, text string")
    values = [F.col("id"), F.col("text")]
    manifest = merkle.build(table, values, F.col("id"), F.col("source"), [F.col("id"), F.replace("text", F.lit("\n"), F.lit(""))])
    assert len(manifest.layers) > 3
    found = sorted((tuple(r) for r in merkle.prove(manifest, whole=False).collect()), key=repr)
    assert found == plain_manifest(rows, tampered)


def test_versions_share_untouched_nodes():
    leaves = [merkle.node_digest(str(i)) for i in range(25)]
    tree = merkle.Tree(leaves, merkle.depth(25))
    before = [list(level) for level in tree.levels]
    version = tree.changed(13, merkle.node_digest("new"))
    assert [at for at, _ in version.copied] == [13, 4, 1, 0] and version.root != tree.root
    again = merkle.Tree([*leaves[:13], merkle.node_digest("new"), *leaves[14:]], merkle.depth(25))
    assert [[version.node(n, i) for i in range(len(level))] for n, level in enumerate(again.levels)] == again.levels
    assert version.root == merkle.fold(merkle.node_digest("new"), tree.siblings(13))
    assert tree.levels == before and tree.root == merkle.fold(leaves[13], tree.siblings(13))
    assert version.node(0, 12) is tree.node(0, 12) and version.node(1, 3) is tree.node(1, 3)


def test_manifest_query_on_edge_rows(spark, tmp_path):
    docs = edge_documents(spark)
    rows = [(r.source, r.doc_id, [r.doc_id, r.source, r.lang, r.n_chars, r.text]) for r in docs.collect()]

    def tampered(values):
        hit = values[0] is not None and zlib.crc32(str(values[0]).encode()) % 2 == 0
        return [*values[:4], values[4].replace("\n", "") if hit and values[4] is not None else values[4]]

    out = queries.QUERIES["op12_merkle_manifest"](spark, written(docs, tmp_path / "t"))
    names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    found = sorted((tuple(r) for r in out.select(*names).collect()), key=repr)
    assert found == plain_manifest(rows, tampered)
    assert {r[6] for r in found} == {True, False}
    empty = queries.QUERIES["op12_merkle_manifest"](spark, written(docs.limit(0), tmp_path / "e"))
    assert empty.columns == names and empty.count() == 0


def test_manifest_of_a_hot_source_is_spread(spark, plan_of):
    rows = spark.range(30_000).select(F.lit("hot").alias("source"), F.col("id"), F.lit("same").alias("text"))
    manifest = merkle.build(rows, [F.col("text")], F.lit(1), F.col("source"))
    # equal keys and equal leaves: still dealt to many tasks, and every position taken once
    assert manifest.leaves.agg(F.count_distinct("position")).first()[0] == 30_000
    assert manifest.layers[1].nodes.count() == -(-30_000 // merkle.BLOCK)
    proofs = merkle.prove(manifest, whole=False)
    assert re.search(r"hashpartitioning\(grp#\d+, block#\d+", plan_of(proofs))
    assert proofs.where("verified").count() == 30_000


# ---- 13 licence scan ----

def plain_scan(text, index):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    names, terms = [], []
    for t in index:
        for start in range(-40, len(words) + 40):
            slack = 0 if t.is_name else licenses.SLACK
            near = [[words[i] for i in range(start + p - slack, start + p + slack + 1) if 0 <= i < len(words)] for p, _ in t.postings]
            share = sum(w in around for (_, w), around in zip(t.postings, near)) / len(t.postings)
            # a place is considered if one of the template's words stands exactly where it belongs
            seeded = any(0 <= start + p < len(words) and words[start + p] == w for p, w in t.postings)
            keys = all(any(s >= 0 and words[s:s + len(k)] == k for s in range(start + p - slack, start + p + slack + 1)) for p, k in t.keys)
            if seeded and keys and share >= licenses.ENOUGH:
                (names if t.is_name else terms).append((start, t.label) if t.is_name else (start, t.label, share))
    score = max([0.5] * bool(names) + [0.5 + 0.5 * s for _, _, s in terms], default=0.0)
    return len(words), sorted(names), sorted(terms), score


def scanned(df):
    return [(r.n_words, [tuple(x) for x in r.name_places], [tuple(x) for x in r.license_terms], r.license_score) for r in df.collect()]


def test_licenses_brute_force(spark):
    rng = random.Random(4)
    bits = ["gnu", "General", "PUBLIC", "license", "apache license", "cc by", "CC-BY", "mit", "MIT License", "the", "a"]
    texts = [" ".join(rng.choice(bits) for _ in range(rng.randint(0, 30))) for _ in range(80)]
    for label, (terms, _) in licenses.TERMS.items():
        words = terms.split()
        texts += [f"# {terms.capitalize()}", f"intro {rng.choice(bits)} {terms} MIT License {terms}", " ".join(words[5:]), " ".join(words[:-4])]
        for _ in range(6):
            changed = list(words)
            for _ in range(rng.randint(1, 10)):
                at = rng.randrange(len(changed))
                changed[at:at + rng.randint(0, 1)] = [rng.choice(["x", "the", "software"])] * rng.randint(0, 2)
            texts.append(" ".join(changed))
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id long, text string").repartition(3).orderBy("id")
    assert scanned(licenses.scan_licenses(docs)) == [plain_scan(t, licenses.INDEX) for t in texts]


def test_licenses_own_index(spark):
    index = licenses.make_index({"a b a": "aba"}, {"own": ("one two three four five six", ["three four"])}, rare_words=3)
    texts = ["a b a b a", "a a b b a", "one two three four five six", "two three four", "one two x three y four", "", None]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id long, text string").coalesce(1)
    assert scanned(licenses.scan_licenses(docs, index=index)) == [plain_scan(t, index) for t in texts]
    with pytest.raises(ValueError):
        licenses.make_index({}, {"own": ("one two", ["two one"])})


def test_licenses_edge_rows(spark):
    docs = edge_documents(spark).withColumn("N_Words", F.lit("clash")).withColumn("w", F.lit(2)).withColumn("m", F.create_map(F.lit("a"), F.lit(1)))
    out = licenses.scan_licenses(docs)
    assert [c.lower() for c in out.columns].count("n_words") == 1 and {"label.of.it", "w", "m"} <= set(out.columns)
    rows = out.collect()
    assert len(rows) == 11
    for row in rows:
        words, names, _, score = plain_scan(row.text, [t for t in licenses.INDEX if t.is_name])
        assert (row.n_words, [tuple(x) for x in row.name_places], row.license_score) == (words, names, score)
    assert licenses.scan_licenses(docs.limit(0)).count() == 0


def test_licenses_native(spark, plan_of, tmp_path):
    plan = plan_of(queries.QUERIES["op13_license_scan"](spark, written(edge_documents(spark), tmp_path / "t")))
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan and "Exchange" not in plan


def test_licenses_long_text_in_linear_time(spark):
    import time

    took = []
    for n in (2_000, 8_000):
        docs = spark.createDataFrame([(1, "mit gnu unencumbered " * n)], "id long, text string")
        licenses.scan_licenses(docs).collect()
        begin = time.perf_counter()
        licenses.scan_licenses(docs).collect()
        took.append(time.perf_counter() - begin)
    assert took[1] < 10 * took[0] + 2
