"""Operators against plain Python on random and awkward input."""

import hashlib
import random

import brute
import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tracewell.llm import (
    decontaminate, embedding_dedup, license_scan, line_dedup, minhash, packing, pii, substring_dedup,
)
from tracewell.llm import words as W

DOCS = "doc_id long, text string"


def rows_of(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


def frame(spark, rows, schema=DOCS):
    return spark.createDataFrame(rows, schema).repartition(3)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(st.sampled_from("aB1 \n\té-,_\x00🙂"), max_size=30), max_size=8), st.integers(1, 40))
def test_words(texts, size):
    for kind, pattern in ((W.ALNUM, brute.ALNUM), (W.SPACED, brute.SPACED)):
        got = []
        for piece in W.pieces(pa.array(texts, pa.string()), size):
            found = W.words_of(piece, kind)
            for lo, hi in zip(found.first[:-1], found.first[1:]):
                got.append([found.lower[s:e].tobytes().decode() for s, e in zip(found.start[lo:hi], found.end[lo:hi])])
        assert got == [brute.words(t, pattern) for t in texts]


def test_sketch_fills_and_estimates():
    rng = np.random.default_rng(1)
    for n in (1, 2, 7, 100, 5000):
        values = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
        assert (minhash.sketch(values) != minhash._NONE).all()
    shared, a, b = (rng.integers(0, 1 << 63, n, dtype=np.uint64) for n in (600, 100, 100))
    x, y = minhash.sketch(np.append(shared, a)), minhash.sketch(np.append(shared, b))
    assert abs((x == y).mean() - 0.75) < 0.15


def test_minhash(spark):
    rng = random.Random(2)
    base = [[rng.choice("the of and x y z w v".split()) + str(rng.randint(0, 30)) for _ in range(n)] for n in (3, 30, 60, 120)]
    rows = [(1000, None), (1001, ""), (1002, " \n"), (1003, "a b"), (1004, "A  b"), (None, "a b"), (7, " ".join(base[1])),
            (7, " ".join(base[2])), (9000, " ".join(base[1])), (9000, " ".join(base[1]))]
    for k in range(120):
        own = list(rng.choice(base))
        for _ in range(rng.randint(0, 4)):
            own[rng.randrange(len(own))] = "new" + str(rng.randint(0, 9))
        rows.append((k * 7 % 131 + 10, " ".join(own)))
    got = rows_of(minhash.near_duplicates(frame(spark, rows)), "doc_id", "n_shingles", "component_id", "kept")
    assert got == sorted(brute.near_duplicates(rows), key=repr)


def test_minhash_group_too_unlike_for_its_least_member(spark):
    """A bucket whose members are linked with each other but not with the least one."""
    words = [f"w{k}" for k in range(100)]
    rows = [(0, " ".join(words[:100]))]
    for k in range(1, 40):
        own = list(words)
        own[10:16] = [f"a{j}" for j in range(6)]
        own[50 + k % 5] = f"b{k % 7}"
        rows.append((k, " ".join(own)))
    got = rows_of(minhash.near_duplicates(frame(spark, rows)), "doc_id", "n_shingles", "component_id", "kept")
    assert got == sorted(brute.near_duplicates(rows), key=repr)


@pytest.mark.parametrize("block", [5, 1 << 16])
def test_decontaminate(spark, block):
    rng = random.Random(4)
    word = lambda: rng.choice("a b c d e f gé 1 2".split())
    items = [(k, " ".join(word() for _ in range(rng.choice((1, 2, 5, 10, 12, 14))))) for k in range(12)]
    items += [(None, "a b"), (50, None), (51, ""), (52, items[3][1]), (53, "unseen words here")]
    rows = [(None, items[0][1]), (3, None), (4, ""), (4, "")]
    for k in range(60):
        own = [word() for _ in range(rng.randint(0, 30))]
        own[rng.randint(0, len(own)): 0] = items[rng.randrange(12)][1].upper().replace(" ", ",\n").split(" ")
        rows.append((k, " ".join(own)))
    benchmark = frame(spark, items, "item_id long, text string")
    found = decontaminate.contaminated_words(frame(spark, rows), benchmark, block_windows=block)
    got = sorted(((r.doc_id, r.found.n_words, r.found.n_hit, len(r.found["items"]),
                   hashlib.sha256(",".join(r.found["items"]).encode()).hexdigest(), r.found.n_hit > 0)
                  for r in found.collect()), key=repr)
    want = sorted(brute.contaminated(rows, items), key=repr)
    assert got == want
    columns = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    assert rows_of(decontaminate.report(frame(spark, rows), benchmark, block_windows=block), *columns) == want


def test_substrings(spark):
    rng = random.Random(3)
    base = ["".join(rng.choice("abcdé ") for _ in range(rng.randint(50, 400))) for _ in range(8)]
    rows = [(None, base[0]), (1000, None), (1001, ""), (1002, "x" * 49), (1003, "x" * 50), (1004, "x" * 300),
            (1005, "ab" * 200), (1006, "ab" * 100), (1006, "ab" * 100), (1007, "x" * 50 + "y"), (7, base[1]),
            (7, base[1] + base[2]), (1008, "\x00" * 120), (1009, "\x00" * 70 + "z")]
    for _ in range(120):
        own = ""
        for _ in range(rng.randint(1, 5)):
            text = rng.choice(base)
            at = rng.randint(0, len(text))
            own += text[at: at + rng.randint(1, 150)] + "".join(rng.choice("abcdefgh") for _ in range(rng.randint(0, 9)))
        rows.append((rng.randint(0, 300), own))
    got = rows_of(substring_dedup.report(frame(spark, rows)), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert got == sorted(brute.repeated_bytes(rows), key=repr)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.binary(min_size=1, max_size=6).map(lambda b: bytes(x % 3 for x in b)), min_size=1, max_size=12),
                max_size=7))
def test_loser_tree(lists):
    runs = [sorted(set(x)) for x in lists]
    coded = []
    for k, run in enumerate(runs):
        docs = np.full(len(run), k, dtype=np.int64).tobytes()
        coded.append(substring_dedup.run_items(*substring_dedup.front_coded(run), docs, bytes(len(run))))
    got = list(substring_dedup.merged(coded))
    assert [g[1] for g in got] == sorted(x for run in runs for x in run)
    for before, (shared, now, _, _) in zip([b"", *(g[1] for g in got)], got):
        same = 0
        while same < min(len(before), len(now)) and before[same] == now[same]:
            same += 1
        assert shared == same


def test_personal_data(spark):
    rng = random.Random(5)
    texts = ["", None, "a@b.com_c@d.com", "a@b.com.x@y.com 1.2.3.4.5.6.7.8 300.1.1.1 01.002.3.255",
             "x4111 1111 1111 1111y 4111-1111-1111-1111  4111111111111111", "é🙂+1 (477) 555-4197 ü 12.158.146.200",
             "1 " * 20_000, "a@" + "b." * 20_000 + "c", "a" * 50_000 + "@", "4 " * 9000 + "4111111111111111",
             "@".join(f"ab.c{k}" for k in range(1000))]
    parts = ["1", "4", "23", "255", ".", "@", "a", "B-", "+", " ", "  ", "-", "(", ")", "4111111111111111", "x.y", "é", "\n", "="]
    texts += ["".join(rng.choice(parts) for _ in range(rng.randint(1, 60))) for _ in range(400)]
    got = {r.doc_id: r for r in pii.report(frame(spark, list(enumerate(texts)))).collect()}
    assert len(got) == len(texts)
    for k, text in enumerate(texts):
        want = brute.personal(text)
        joined = ",".join(f"{kind}:{a}:{b}" for kind, a, b in want)
        assert got[k].base_sha256 == hashlib.sha256(joined.encode()).hexdigest(), text
        counts = [sum(kind == x for x, _, _ in want) for kind in pii.KINDS]
        assert [got[k].n_email, got[k].n_ip, got[k].n_card, got[k].n_phone] == counts


def _added(spark, texts):
    found = pii.find(frame(spark, list(enumerate(texts))))
    return {(r.doc_id, x.kind, x.start, x.end) for r in found.select("doc_id", "added").collect() for x in r.added}


def test_contexts_discover_identifiers(spark):
    rows = [(k, f"lorem ipsum, contact me: user{k}@mail.com or") for k in range(30)]
    rows += [(100 + k, f"blah contact me: user_at_host{k}7. thanks") for k in range(4)] + [(200, "seen user_at_host27 elsewhere")]
    got = {r.doc_id: r.spans for r in pii.report(frame(spark, rows)).collect()}
    assert got[102] == "email:17:31" and got[3] == "email:25:39" and got[200] == ""


def test_found_values_open_further_contexts(spark):
    """Seeds open "write to"; what is found there, without digits too, opens "reach desk", where others stand, and so on."""
    texts = [f"please write to: user{k}@mail.com soon" for k in range(40)]
    names = [f"{c}nn_at_host" for c in "abcdefghijkl"]
    texts += [f"now write to: {x} soon" for x in names] + [f"then reach desk {x} today" for x in names]
    texts += ["then reach desk eve_at_host today", "nothing else at eve_at_host here", "y" * 90 + "reach desk gil_at_host"]
    got = _added(spark, texts)
    assert got == brute.personal_contexts(texts, pii)
    assert {k for k, *_ in got} == {*range(40, 65), 66} and (64, "email", 16, 27) in got


def test_secrets(spark):
    keys = [hashlib.sha1(str(k).encode()).hexdigest() for k in range(12)]
    texts = [f'some text token = "{x}" more' for x in keys[:8]] + [f"commit of {x}" for x in keys[8:11]]
    texts += [f"commit of page{k}0" for k in range(9)] + ['TOKEN = "short.and-odd_99" end', "sha " + keys[0], ""]
    got = _added(spark, texts)
    assert got == brute.personal_contexts(texts, pii)
    assert {k for k, *_ in got} == {*range(8), 20} and (20, "secret", 9, 25) in got


def test_contexts_by_force(spark):
    rng = random.Random(77)
    parts = ["call", "key", "mail", "to", "of", "id", ":", "=", "\n", "é", "ab", "x" * 90]
    own = [f"u{k}@h.org" for k in range(9)] + [f"+1 555 000 1{k}2" for k in range(9)] + [f"q_{c}" for c in "abcdef"] + ["a1", "b-2", "300.1.1.1"]
    texts = []
    for _ in range(400):
        words = [rng.choice(parts) for _ in range(rng.randint(0, 9))]
        for _ in range(rng.randint(0, 3)):
            where = rng.choice([("mail", own[:9]), ("call", own[9:18]), ("key", own[18:])])
            words += [where[0], rng.choice(where[1] if rng.random() < 0.9 else own)]
        texts.append(" ".join(words))
    got = _added(spark, texts)
    assert got == brute.personal_contexts(texts, pii) and got


@settings(max_examples=300, deadline=None)
@given(st.text("abc ", max_size=25), st.text("abc ", max_size=25), st.sampled_from([50, 75, 90]))
def test_edit_similarity(a, b, percent):
    longest = max(len(a), len(b))
    assert line_dedup.edit_similar(a, b, percent) == (100 * (longest - brute.distance(a, b)) >= percent * longest)


def _lines_by_force(rows):
    lines = {}
    for d, text in rows:
        for n, line in enumerate((text or "").split("\n")):
            own = tuple("".join("0" if c in "0123456789" else c for c in w) for w in brute.words(line, brute.ALNUM))
            if len(own) >= line_dedup.MIN_WORDS:
                lines.setdefault(own, []).append(((d is None, d), n))
    keys = sorted(lines)
    texts = [" ".join(k) for k in keys]
    links = [(i, j) for i in range(len(keys)) for j in range(i)
             if 10 * brute.distance(texts[i], texts[j]) <= max(len(texts[i]), len(texts[j]))]
    comp, first = groups_of(len(keys), links), {}
    for k, own in enumerate(keys):
        first[comp[k]] = min([*lines[own], *([first[comp[k]]] if comp[k] in first else [])], key=lambda p: (p[0][0], p[0][1] or 0, p[1]))
    cut = {place for k, own in enumerate(keys) for place in lines[own] if place != first[comp[k]]}
    return sorted(
        ((d, "\n".join(x for n, x in enumerate((t or "").split("\n")) if ((d is None, d), n) not in cut)) for d, t in rows),
        key=repr), len(links)


def groups_of(n, links):
    return brute.groups(range(n), links)


def test_lines(spark):
    rng = random.Random(6)
    vocabulary = [f"word{k}" for k in range(60)]
    base = [" ".join(rng.choice(vocabulary) for _ in range(rng.randint(5, 60))) for _ in range(12)]
    rows = [(500, None), (501, ""), (502, "a b c d"), (503, "a b c d"), (None, base[0])]
    for k in range(80):
        own = []
        for _ in range(rng.randint(1, 4)):
            line = rng.choice(base)
            if rng.random() < 0.5:
                line = line.replace("word1", "Word-1", 1) if rng.random() < 0.5 else line.replace("word2 ", "word3 ", 1)
            own.append(line + rng.choice(["", ".", " !", f" {rng.randint(0, 9)}"]))
        own.append("short one")
        rows.append((k, "\n".join(own)))
    want, links = _lines_by_force(rows)
    assert links > 0
    got = line_dedup.without_repeated_lines(frame(spark, [(d, t or "") for d, t in rows]))
    assert rows_of(got, "doc_id", "text") == want


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=40))
def test_best_fit(lengths):
    capacities = [8, 16, 64]
    lengths = sorted(lengths, reverse=True)
    bins, offsets, final = packing.pack_jointly(lengths, capacities, 2)
    by_bin = {}
    for n, b, at in zip(lengths, bins, offsets):
        assert by_bin.get(b, 0) == at
        by_bin[b] = at + n
    assert all(min(c for c in capacities if c >= n) == final[b] for b, n in by_bin.items())
    room, opened = [], []  # plain best fit that always opens the largest
    for n in lengths:
        fits = [(r, k) for k, r in enumerate(room) if r >= n]
        if fits:
            _, k = min(fits)
        else:
            k = len(room)
            room.append(64)
        room[k] -= n
    opened = sum(min(c for c in capacities if c >= 64 - r) + 2 for r in room)
    assert sum(final) + 2 * len(final) <= opened


def _least_cost(lengths, capacities, overhead):
    """The cost of the best packing there is, over all ways to share the pieces out."""
    subsets = range(1 << len(lengths))
    total = [sum(n for k, n in enumerate(lengths) if s >> k & 1) for s in subsets]
    cost = [0] * len(subsets)
    for s in subsets[1:]:
        part, options = s, []
        while part:  # the bin of the first piece left
            if part & (s & -s) and total[part] <= capacities[-1]:
                options.append(cost[s ^ part] + overhead + next(c for c in capacities if c >= total[part]))
            part = (part - 1) & s
        cost[s] = min(options)
    return cost[-1]


def test_best_fit_near_the_optimum():
    rng, capacities = random.Random(9), [8, 16, 64]
    got, optimum, exact = 0, 0, 0
    for _ in range(300):
        lengths = sorted((rng.randint(1, rng.choice([6, 20, 64])) for _ in range(rng.randint(1, 8))), reverse=True)
        final = packing.pack_jointly(lengths, capacities, 2)[2]
        cost, least = sum(final) + 2 * len(final), _least_cost(lengths, capacities, 2)
        assert cost >= least
        for c in capacities:
            plain = packing.best_fit(lengths, packing.at_least(lengths, capacities, c))[2]
            assert cost <= sum(next(x for x in capacities if x >= f) + 2 for f in plain)
        got, optimum, exact = got + cost, optimum + least, exact + (cost == least)
    assert got <= 1.03 * optimum and exact >= 200, (got / optimum, exact)


def test_packing_is_whole(spark):
    rng = random.Random(8)
    rows = [(k, " ".join("w" for _ in range(rng.choice((0, 1, 40, 700, 9000))))) for k in range(60)] + [(3, "a b"), (3, "a b"), (None, "x"), (99, None)]
    packed = packing.pack(frame(spark, rows), shard_length=20_000).collect()
    assert sum(r.length for r in packed) == sum(len((t or "").split()) for _, t in rows)
    bins = {}
    for r in packed:
        bins.setdefault((r.shard, r.bin), []).append((r.offset, r.length, r.capacity))
    assert len({r.shard for r in packed}) > 1
    for own in bins.values():
        own.sort()
        assert [o for o, _, _ in own] == [sum(n for _, n, _ in own[:k]) for k in range(len(own))]
        total = sum(n for _, n, _ in own)
        assert {c for _, _, c in own} == {min(c for c in packing.CAPACITIES if c >= total)}
    assert sorted(r.copy for r in packed if r.doc_id == 3 and r.length == 2) == [1, 2]


def test_embeddings(spark):
    rng = np.random.default_rng(9)
    centres = rng.normal(size=(15, 12))
    vectors = [(int(k), (centres[rng.integers(15)] + rng.normal(size=12) * rng.choice([0.02, 0.15, 0.6])).tolist()) for k in rng.permutation(400)]
    vectors += [(1000, vectors[0][1]), (1001, vectors[0][1]), (1002, (np.array(vectors[1][1]) * 7).tolist()), (1003, [1e-200] * 12),
                (1004, [1e200] * 12)]
    odd = [(2000, None), (2001, []), (2002, [0.0] * 12), (2003, [1.0, None]), (2004, [float("nan")] * 12),
           (2005, [float("inf")] + [0.0] * 11), (2006, [1.0, 1.0]), (2007, [2.0, 2.0]), (2008, [1.0]), (None, vectors[0][1])]
    df = frame(spark, vectors + odd, "vec_id long, embedding array<double>")
    full = {k: embedding_dedup.unit_rows(np.array([v]))[0] for k, v in [*vectors, (2006, [1.0, 1.0]), (2007, [2.0, 2.0]), (2008, [1.0])]}
    links = [(a, b) for a in full for b in full if a > b and len(full[a]) == len(full[b]) and full[a] @ full[b] >= 0.9]
    comp = brute.groups([k for k, _ in vectors + odd if k is not None], links)
    count = {k: sum(k in x for x in links) for k in comp}
    want = sorted([(k, count[k], comp[k], comp[k] == k) for k in comp] + [(None, 0, None, True)], key=repr)
    for tile in (4096, 37):
        got = embedding_dedup.near_duplicates(df, tile=tile)
        assert rows_of(got, "vec_id", "n_links", "component_id", "kept") == want


def test_embeddings_by_blocks(spark, monkeypatch):
    """Blocks of tiles meet all tiles where they are stored: no vector is shuffled to be compared, floats stay floats."""
    compared, stored = [], embedding_dedup.Scratch.stored

    def seen(self, df, purpose):
        plan = df._jdf.queryExecution().executedPlan().toString()
        if purpose.startswith("vector-links"):
            compared.append(plan[plan.index("MapInArrow"):])
        if purpose == "vector-groups":
            assert df.schema["embedding"].dataType.elementType.typeName() == number
        return stored(self, df, purpose)

    monkeypatch.setattr(embedding_dedup.Scratch, "stored", seen)
    rng = np.random.default_rng(19)
    centres = rng.normal(size=(9, 24))
    vectors = (centres[rng.integers(9, size=300)] + rng.normal(size=(300, 24)) * rng.choice([0.05, 0.3, 0.7], size=(300, 1))).astype(np.float32)
    vectors[200:204] = vectors[7]
    unit = embedding_dedup.unit_rows(vectors)
    near = unit @ unit.T >= 0.9
    links = [(a, b) for a in range(300) for b in range(a) if near[a, b]]
    comp = brute.groups(list(range(300)), links)
    want = sorted([(k, int(near[k].sum()) - 1, comp[k], comp[k] == k) for k in range(300)], key=repr)
    for number in ("float", "double"):
        df = frame(spark, [(k, v.tolist()) for k, v in enumerate(vectors)], f"vec_id long, embedding array<{number}>")
        monkeypatch.setattr(embedding_dedup, "BLOCK_BYTES", 4096)
        compared.clear()
        assert rows_of(embedding_dedup.near_duplicates(df, tile=20), "vec_id", "n_links", "component_id", "kept") == want
        assert len(compared) > 3 and not any("Exchange" in x for x in compared)


def test_rough_products_leave_out_no_link():
    """The first stretch in single precision keeps pairs at and beside the threshold, whatever the width."""
    rng = np.random.default_rng(20)
    for width in (1, 5, 16, 17, 64, 200):
        left = rng.normal(size=(60, width))
        right = np.concatenate([left + rng.normal(size=left.shape) * 0.48, rng.normal(size=(300, width))])
        right[0] = left[0] * 3
        x, y = embedding_dedup.unit_rows(left), embedding_dedup.unit_rows(right)
        exact = np.einsum("id,jd->ij", x, y)
        at = float(exact[3, 3])
        for threshold in (0.9, at):
            i, j = embedding_dedup.linked(x, y, threshold, left, right)
            want = np.argwhere(exact >= threshold - (1e-12 if threshold == at else 0))
            got = set(zip(i.tolist(), j.tolist()))
            assert got <= set(map(tuple, want.tolist())) and {tuple(p) for p in want.tolist()} - got <= {(3, 3)}


def test_licences(spark):
    rng = random.Random(10)
    parts = ["cc", "BY", "CC-by", "general", "public", "License", "all rights", "reserved.", "x", "\n", "nc"]
    rows = [(k, " ".join(rng.choice(parts) for _ in range(rng.randint(0, 40)))) for k in range(150)] + [(None, None), (5, "")]
    want = []
    for d, text in rows:
        own, places = brute.words(text, brute.ALNUM), []
        for phrase, label in license_scan.BASE_PHRASES.items():
            p = phrase.split()
            places += [(k, label) for k in range(len(own)) if own[k: k + len(p)] == p]
        at = [k for k, _ in places]
        want.append((d, len(own), len(places), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in places}))))
    got = license_scan.report(frame(spark, rows))
    assert rows_of(got, "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels") == sorted(want, key=repr)
    assert got.filter("score < 0 or score > 1 or (labels = '') <> (score = 0)").count() == 0


@pytest.mark.parametrize(("text", "order", "duty"), [
    ("MIT", "mit", 1),
    ("(MIT OR Apache-2.0) AND GPL-2.0-only WITH Classpath-exception-2.0 */ x",
     "mit apache-2.0 or gpl-2.0-only classpath-exception-2.0 with and", 2),
    ("GPL-3.0 or MIT and MPL-2.0", "gpl-3.0 mit mpl-2.0 and or", 2),
    ("MIT OR", "mit", 1), ("(MIT", "", -1), ("and MIT", "", -1), ("", "", -1), ("Unknown-1", "unknown-1", 4),
])
def test_licence_expressions(text, order, duty):
    found = license_scan.postfix(text.encode())
    assert " ".join(found) == order and license_scan.obligation(found) == duty


@pytest.mark.parametrize(("text", "order", "duty"), [
    (" the GNU General Public License, version 3.", "gpl", 3), (" CC BY-NC 4.0.", "cc-by-nc", 4),
    (" either the MIT License or the Apache License 2.0, at your option", "mit apache or", 1),
    (" (MIT or BSD-3) and GPL v2 or any later version with Classpath Exception!", "mit bsd or gpl classpath-exception with and", 2),
    (" MIT with pleasure", "mit", 1), (" mitten", "", -1), (" (MIT", "", -1), ("", "", -1), (" our own terms", "", -1),
])
def test_licence_names_in_prose(text, order, duty):
    found = license_scan.postfix(text.encode(), read=license_scan._named)
    assert " ".join(found) == order and license_scan.obligation(found) == duty


def _expression(rng, depth):
    """(text, binding strength, obligation, licences) of a random expression."""
    if not depth or rng.random() < 0.2:
        name, label, duty = rng.choice([("MIT", "mit", 1), ("GPL", "gpl", 3), ("MPL 2.0", "mpl", 2), ("CC BY-NC 4.0", "cc-by-nc", 4),
                                        ("the Apache License", "apache", 1), ("CC0", "cc0", 0)])
        if rng.random() < 0.2:
            return f"{name} with Classpath Exception", 3, max(duty - 1, 0), {label}
        return name, 4, duty, {label}
    strength, word, best = rng.choice([(1, "or", min), (2, "and", max)])
    sides = [_expression(rng, depth - 1) for _ in range(2)]
    texts = [f"({t})" if s < strength else t for t, s, *_ in sides]
    return f"{texts[0]} {word} {texts[1]}", strength, best(sides[0][2], sides[1][2]), sides[0][3] | sides[1][3]


def test_licence_expressions_in_documents(spark):
    rng = random.Random(21)
    trees = [_expression(rng, rng.randint(0, 4)) for _ in range(200)]
    rows = [(k, f"x y. Licensed under {t}. More text follows") for k, (t, *_) in enumerate(trees)]
    rows += [(900, "licensed under " * 3000), (901, "Licensed under " + "(" * 5000 + "MIT" + ")" * 5000)]
    got = {r.doc_id: r for r in license_scan.report(frame(spark, rows)).collect()}
    for k, (text, _, duty, own) in enumerate(trees):
        assert got[k].obligation == duty and own <= set(got[k].labels.split(",")) and len(got[k].expressions) == 1, text
    assert not got[900].expressions and got[901].expressions == ["mit"]
    assert got[0].score > got[900].score > 0


def test_groups_of_substrings_by_force():
    """Two, some and many suffixes with one anchor, against all of their strings; none is sliced twice for a smaller group."""
    rng = random.Random(1)
    for size in [2] * 400 + [3, 9] * 100 + [substring_dedup.FEW + 5] * 5:
        anchor, after, before = (bytes(rng.choice(b"ab") for _ in range(n)) for n in (16, 34, 34))
        group: dict[bytes, list] = {}
        while len(group) < size:
            a, b = bytearray(after), bytearray(before)
            for part in (a, b):
                if rng.random() < 0.7:
                    part[rng.randrange(34)] = rng.choice(b"cdefgh")
            n = rng.randint(16, 50)
            suffix = (anchor + a)[:n] + b[: rng.randint(50 - n, 34)] + bytes((n,))
            group[suffix] = [suffix, rng.randint(1, 2), rng.random() < 0.3]
        seen: dict[tuple, list] = {}
        strings = []
        for suffix, low, several in group.values():
            head, tail = substring_dedup._stretch(suffix)
            whole = head + tail
            for k in range(len(whole) - 49):
                key = (len(head) - k, whole[k: k + 50])
                seen.setdefault(key, []).append((low, several))
                strings.append((whole, len(head), k, key))
        want = set()
        for whole, head, k, key in strings:
            lows = {low for low, _ in seen[key]}
            if len(lows) > 1 or any(several for _, several in seen[key]):
                want.add((whole, head, k, min(lows)))
        out: list[tuple] = []
        substring_dedup._group_rows(list(group.values()), out)
        got = [(whole, head, k, low) for whole, head, first, last, low in out for k in range(first, last + 1)]
        assert len(got) == len(set(got)) and set(got) == want


def test_pairs_of_suffixes_are_not_sliced(monkeypatch):
    """Most groups have two suffixes; what they share is told without looking at each of their strings."""
    looked = []
    common = getattr(substring_dedup, "_common", None)
    monkeypatch.setattr(substring_dedup, "_common", lambda a, b: looked.append(1) or common(a, b), raising=False)
    text = bytes(range(60, 120))
    out: list[tuple] = []
    group = [[text[:45] + text[45:n] + bytes((45,)), low, False] for n, low in ((60, 3), (55, 1))]
    substring_dedup._group_rows(group, out)
    assert len(looked) == 2 and {row[4] for row in out} == {1}
