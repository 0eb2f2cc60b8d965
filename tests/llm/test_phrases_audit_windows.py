"""Phrase collocations, the filter audit and order-preserving packing against brute force on small fixtures."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
import public_tokenizers
import pytest

from granero.llm import collocations
from granero.llm.collocations import count_keys, mine_phrases, pair_keys, sum_cells, tiles_of, words_of
from granero.llm.filter_audit import audit_filters, edge_weights, path_counts
from granero.llm.ordered_packing import RECORD_END, best_cuts, candidate_cuts, pack_in_order
from granero.llm.tokens import ids_of, sentence_ends

PATH = public_tokenizers.path("byte_bpe_50k.json")
LOWER = {c: c + 32 for c in range(65, 91)}

# ---- phrases

INCIDENT = "descripcion string, tipo_incidente string, grp string, block int, f int, n string, rank int"


def incidents(frame, rows):
    """Incidents with other columns whose names the operator uses itself."""
    return frame([(text, kind, "x", 1, 2, "y", 3) for text, kind in rows], INCIDENT)


def expected_phrases(rows, min_count, per_group=2000):
    counts, words = defaultdict(Counter), Counter()
    for text, kind in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            found = re.findall(r"[^\x20\x09]+", piece)
            words[kind or "und"] += len(found)
            for k in (1, 2, 3, 4):
                counts[kind or "und"].update(tuple(found[i:i + k]) for i in range(len(found) - k + 1))
    out = []
    for kind, f in counts.items():
        kept = {p: a for p, a in f.items() if len(p) > 1 and a >= min_count}
        best = []
        for p, a in kept.items():
            if any(len(q) > len(p) and 100 * b >= 80 * a and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1))
                   for q, b in kept.items()):
                continue
            score, _, left, right = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            best.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(best)[:per_group], 1):
            out.append((kind, rank, phrase.decode(), -a, left, right, words[kind], -score))
    return sorted(out)


def reports_of(seed, n, kinds=("Derrame", None, "und", "Robo")):
    rng = random.Random(seed)
    stock = ["urea", "DAP", "bulto", "roto", "el", "el", "camión", "\xa0x", "\x1cy", "de", "De", "de", "#"] + [f"w{i}" for i in range(30)]
    ends = [" ", " ", "  ", "\t", ". ", ", ", "\n", "!", "\x0b"]
    rows = []
    for i in range(n):
        words = rng.choices(stock, k=rng.randrange(40))
        if i % 3 == 0:
            words[3:3] = ["saldo", "a", "favor", "del"]
        if i % 4 == 0:
            words[1:1] = ["muy", "muy", "muy", "muy", "muy", "tarde"]
        rows.append(("".join(w + rng.choice(ends) for w in words), kinds[i * i % len(kinds)]))
    return rows + [(None, "Derrame"), ("", None), (" . , \n", "solo"), ("una sola", "otra")] + rows[:7]


@pytest.mark.parametrize("mass", [40, 2_000_000])
def test_phrases(frame, monkeypatch, mass):
    monkeypatch.setattr(collocations, "SLICE_BYTES", 7)
    rows = reports_of(1, 300)
    found = mine_phrases(incidents(frame, rows), min_count=4, tile_mass=mass)
    assert found.columns == ["tipo_incidente", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(tuple(r) for r in found.collect()) == expected_phrases(rows, 4)
    assert any(len(r["phrase"].split()) == 4 for r in found.collect())


def test_phrases_of_nothing_and_limits(frame):
    assert mine_phrases(incidents(frame, [])).collect() == []
    assert mine_phrases(incidents(frame, [(None, None), ("solo", "a")]), min_count=2).collect() == []
    rows = reports_of(2, 60)
    assert sorted(tuple(r) for r in mine_phrases(incidents(frame, rows), min_count=2, per_group=5).collect()) == expected_phrases(rows, 2, 5)


def test_one_phrase_holds_a_third_of_everything(frame):
    rows = [("saldo a favor " * 200, "hot")] * 40 + reports_of(3, 60)
    assert sorted(tuple(r) for r in mine_phrases(incidents(frame, rows), min_count=5, tile_mass=500).collect()) == expected_phrases(rows, 5)


def test_words_are_never_cut(monkeypatch):
    text = "uno dos.TRES\t\tcuatro, " * 50 + "x" * 300
    whole = [w for part in words_of(text.encode()) for w in part]
    for size in (1, 3, 10):
        monkeypatch.setattr(collocations, "SLICE_BYTES", size)
        assert [w for part in words_of(text.encode()) for w in part] == whole
    assert whole[:6] == [b"uno", b"dos", b"\xff", b"tres", b"cuatro", b"\xff"] and list(words_of(b"")) == []


def test_tiles_count_what_sorting_counts():
    rng = np.random.default_rng(4)
    ids = np.minimum(rng.zipf(1.3, 20_000), 5000).astype(np.uint32)
    ids[rng.random(20_000) < 0.1] = 0
    at, keys = pair_keys(ids)
    expect = Counter((int(a), int(b)) for a, b in zip(ids, ids[1:]) if a and b)
    assert len(at) == sum(expect.values())
    for corner in (1, 64, 8192):
        found, counts = count_keys(keys, corner)
        assert {(int(k >> np.uint64(32)), int(k & np.uint64(0xFFFFFFFF))): int(c) for k, c in zip(found, counts)} == expect
        assert (np.diff(found.astype(object)) > 0).all()
    parts = np.concatenate([found, found[::2]]), np.concatenate([counts, counts[::2]])
    dense, sparse = sum_cells(*parts, dense_cells=1 << 26), sum_cells(*parts, dense_cells=0)
    assert (dense[0] == sparse[0]).all() and (dense[1] == sparse[1]).all()


def test_tiles_are_rectangles_without_overlap():
    bounds = np.array([1, 1, 1, 2, 5, 9, 20])  # the first id alone passes three bounds
    first, second = (x.ravel() for x in np.meshgrid(np.arange(1, 30), np.arange(1, 30), indexing="ij"))
    strip, part = tiles_of(first, second, bounds)
    assert len({(s, p) for s, p, x in zip(strip, part, first) if x == 1}) == 3
    seen = defaultdict(list)
    for s, p, x, y in zip(strip.tolist(), part.tolist(), first.tolist(), second.tolist()):
        seen[s, p].append((x, y))
    for cells in seen.values():
        xs, ys = {x for x, _ in cells}, {y for _, y in cells}
        assert len(cells) == len(xs) * len(ys) and max(ys) - min(ys) + 1 == len(ys)


# ---- filter audit

def brute_audit(rows, labels):
    good, toxic = Counter(), Counter()
    for key, q, t in labels:
        good[key] |= q == 1
        toxic[key] |= t == 1
    fails = []
    for key, text, part in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        own = {n for n, f in (
            ("A", len(words) < 50), ("B", 100 * len(set(words)) < 65 * len(words)),
            ("C", 100 * len(re.findall("[A-Z]", text)) > 5 * len(text)), ("D", re.search(r"[#$%&*|]", text)),
            ("E", key is not None and any(k is not None and k < key and (t or "") == text for k, t, _ in rows))) if f}
        fails.append((part or "", own, key is not None and good[key], key is not None and toxic[key]))
    out, share = {}, Counter()
    for part in {f[0] for f in fails}:
        mine = [f for f in fails if f[0] == part]
        for order in permutations("ABCDE"):
            left = mine
            for step, letter in enumerate(order, 1):
                gone = [f for f in left if letter in f[1]]
                left = [f for f in left if letter not in f[1]]
                share[part, letter] += len(gone)
                out[part, "".join(order), step] = (
                    len(left), len(gone), sum(letter in f[1] for f in mine) - len(gone), sum(f[1] == {letter} for f in mine),
                    sum(f[2] for f in gone), sum(f[3] for f in gone))
    return {(*k, *v, share[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def audit_rows(seed=5):
    rng = random.Random(seed)
    stock = [f"palabra{i}" for i in range(200)]
    rows = []
    for i in range(60):
        text = " ".join(rng.choices(stock[:rng.choice([5, 40, 200])], k=rng.choice([10, 49, 50, 80])))
        text = text.upper() if rng.random() < 0.2 else text
        rows.append((i, text + rng.choice(["", " #", " |", ""]), rng.choice(["a", "b", None, ""])))
    rows += [(100 + i, rows[i % 9][1], rng.choice("abc")) for i in range(30)]
    rows += [(200, None, "a"), (201, "", "c"), (None, rows[0][1], "a"), (None, rows[0][1], "a"), (0, *rows[0][1:]), (3, rows[3][1], "z"), (7, "otro", "a")]
    labels = [(k, rng.choice([0, 1, None, 2]), rng.choice([0, 1])) for k in range(0, 130, 2)] + [(4, 1, 0), (4, 0, 1), (None, 1, 1), (999, 1, 1)]
    return rows, labels


RECORD = "ln_folio_incidencia long, descripcion string, responsable_cdf string, _key int, _part string, n int, fails int, _salt int"
LABEL = "ln_folio_incidencia long, validada int, toxica int, _good string, _part int"


def test_filter_audit(frame):
    rows, labels = audit_rows()
    found = audit_filters(frame([(*r, 1, "x", 2, 3, 4) for r in rows], RECORD), frame([(*r, "x", 1) for r in labels], LABEL))
    assert found.columns == ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    got = [tuple(r) for r in found.collect()]
    assert len(got) == 600 * len({r[2] or "" for r in rows}) and set(got) == brute_audit(rows, labels)
    nobody = frame([], LABEL)
    assert audit_filters(frame([], RECORD), nobody).collect() == []
    alone = audit_filters(frame([(None, None, None, 1, "x", 2, 3, 4)], RECORD), nobody).collect()
    assert len(alone) == 600 and {(r["filter_order"][r["step"] - 1], r["shapley"]) for r in alone} == {("A", 120), ("B", 0), ("C", 0), ("D", 0), ("E", 0)}


def test_paths_through_the_lattice():
    for n in (1, 3, 5):
        reach, leave = path_counts(n)
        orders = list(permutations(range(n)))
        assert reach[-1] == leave[0] == len(orders)
        for state, f, weight in edge_weights(n):
            before = {g for g in range(n) if state >> g & 1}
            assert weight == sum(set(o[:len(before)]) == before and o[len(before)] == f for o in orders)


# ---- packing in order

def least_cost(marks, capacity, sentence, cut):
    """Least padding plus penalties over the cuts that `best_cuts` may choose from, by trying every start for every place."""
    places, kinds = candidate_cuts(marks, capacity)
    cost = {0: 0}
    for place, kind in zip(places[1:].tolist(), kinds[1:].tolist()):
        last = place == len(marks)
        options = []
        for start in cost:
            n = place - start
            if n <= capacity and (kind or last or n == capacity):
                options.append(cost[start] + (0 if n & (n - 1) == 0 or n == capacity else capacity - n))
        if options:
            cost[place] = min(options) + (0 if last else (cut, sentence, 0)[kind])
    return cost[len(marks)]


@pytest.mark.parametrize("capacity", [8, 12, 64])
def test_cuts_are_the_best(capacity):
    rng = np.random.default_rng(capacity)
    for n in (1, 5, 63, 64, 65, 400):
        for share in (0.02, 0.2, 0.9):
            marks = rng.choice(3, n, p=[1 - share, share * 0.7, share * 0.3]).astype(np.int8)
            marks[-1] = RECORD_END
            cuts = best_cuts(marks, capacity, 2, 5)
            lengths = np.diff(np.concatenate([[0], cuts]))
            assert cuts[-1] == n and (lengths > 0).all() and (lengths <= capacity).all()
            padding = np.where((lengths & (lengths - 1) == 0) | (lengths == capacity), 0, capacity - lengths).sum()
            fees = np.array([5, 2, 0])[marks[cuts[:-1] - 1]].sum()
            assert padding + fees == least_cost(marks, capacity, 2, 5)


def test_windows(frame):
    rng = random.Random(6)
    texts = [None, "", ".", "a <|endoftext|> b", "x" * 5000, "Fin.\n" * 700] + [
        ". ".join(" ".join(rng.choices(["urea", "el", "camión", "báscula", "7"], k=rng.randrange(1, 30))) for _ in range(rng.randrange(40))) for _ in range(60)]
    keys = [f"F{i:03d}" for i in range(len(texts))]
    records = frame([(k, t, "x", 1) for k, t in zip(keys, texts)], "ln_folio_incidencia string, descripcion string, _key string, start int").repartition(3)
    for segment in (1, 2000, 1 << 20):
        out = pack_in_order(records, capacity=128, segment=segment).collect()
        pieces, windows = defaultdict(list), defaultdict(list)
        for r in out:
            pieces[r["ln_folio_incidencia"]].append(r)
            windows[r["sequence_id"]].append(r)
        assert set(pieces) == set(keys)
        for key, text in zip(keys, texts):
            ids, at = np.append(ids_of(text, PATH), 0).astype("<u4"), 0
            for r in sorted(pieces[key], key=lambda r: r["start"]):
                assert (r["start"], r["doc_tokens"]) == (at, len(ids)) and r["ids_crc32"] == zlib.crc32(ids[at:at + r["length"]].tobytes())
                at += r["length"]
            assert at == len(ids)
        for rows in windows.values():
            at = 0
            for r in sorted(rows, key=lambda r: r["offset"]):
                assert r["offset"] == at
                at += r["length"]
            assert at <= 128
    repeated = frame([(None, "hola.", "x", 1)] * 3, "ln_folio_incidencia string, descripcion string, _key string, start int")
    assert len(pack_in_order(repeated).collect()) == 3 and pack_in_order(repeated.limit(0)).collect() == []


def test_sentences_end_where_they_should():
    text = "Llegó tarde. Faltan 3.5 t!\n\"No?\" dijo"
    ids = ids_of(text, PATH)
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(PATH)
    parts, begin = [], 0
    for i, end in enumerate(sentence_ends(ids, PATH)):
        if end:
            parts.append(library.decode(ids[begin:i + 1].tolist()))
            begin = i + 1
    assert parts == ["Llegó tarde.", " Faltan 3.5 t!\n", "\"No?\""] and not len(sentence_ends(ids[:0], PATH))
