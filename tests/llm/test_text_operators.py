"""The text operators against brute force on small fixtures: nulls, ties, repeated rows, long texts, clashing names."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql.classic.dataframe import DataFrame

from granero.llm.byte_bpe import Codec, encode_and_decode
from granero.llm.components import components
from granero.llm.dialogues import rotate_perspectives
from granero.llm.license_scan import LICENSE_NOTICES, align, scan_templates, winnow
from granero.llm.lm_scoring import PAIR_BITS, SMOOTHING, WORD_BITS, classes, score_against_target
from granero.llm.near_copies import near_copy_groups, near_copy_links
from granero.llm.packing import CAPACITY, best_fit, cut, pack_histogram, pack_texts
from granero.llm.quality_rules import quality_verdicts
from granero.llm.series_search import nearest_series
from granero.llm.text_blocks import expand, squeeze
from granero.llm.tokens import encoding, ids_of
from granero.llm.toxicity import score_toxicity
from granero.llm.warc import archive_pages

WORD = re.compile(r"[^\x20\x09-\x0D]+")
INCIDENT = "ln_folio_incidencia string, descripcion string, idioma string, n_words string, _key int, _text int"


def incidents(frame, texts, keys=None):
    """Incidents with other columns whose names the operators use themselves."""
    keys = keys or [f"F{i:04d}" for i in range(len(texts))]
    return frame([(k, t, "es", "x", 1, 2) for k, t in zip(keys, texts)], INCIDENT)


def sentences(seed, n, words=90):
    rng = random.Random(seed)
    stock = ["bulto", "urea", "camión", "llegó", "tarde", "mojado", "roto", "falta", "báscula", "ticket"] + [
        "".join(rng.choices("abcdeiou", k=6)) for _ in range(200)]
    return [" ".join(rng.choices(stock, k=words)) for _ in range(n)]


# ---- quality rules

def base_counts(text):
    text = text or ""
    words, seen, dup, places = WORD.findall(text), set(), 0, defaultdict(list)
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    for i in range(len(words) - 2):
        places[tuple(words[i:i + 3])].append(i)
    covered = {j for at in places.values() if len(at) > 1 for i in at for j in (i, i + 1, i + 2)}
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), dup, len(covered), failed


def test_quality_counts_and_verdicts(frame):
    clean = sentences(1, 30)
    texts = clean + [None, "", " \t\n", "a b c", "a b a b a b a", "uno dos tres\nuno dos tres\n\nx", "😀 é\x00b\x1cc\x85d",
                     "w " * 3000, "### $$$ %%% " * 5 + "*** " + clean[0].replace(" ", "## "), clean[0]]
    out = quality_verdicts(incidents(frame, texts)).collect()
    got = {r["ln_folio_incidencia"]: r for r in out}
    assert len(out) == len(texts)
    for i, text in enumerate(texts):
        r = got[f"F{i:04d}"]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) == base_counts(text)
        assert not (r["base_failed"] and r["kept"])
    assert all(got[f"F{i:04d}"]["kept"] for i in range(30))
    symbols = got[f"F{len(texts) - 2:04d}"]
    assert not symbols["base_failed"] and not symbols["kept"]  # far from every language's characters
    assert got[f"F{len(texts) - 1:04d}"]["kept"]


def test_quality_of_nothing(frame):
    assert quality_verdicts(incidents(frame, [])).collect() == []
    assert len(quality_verdicts(incidents(frame, ["a b", "a b"], [None, None])).collect()) == 2


# ---- archives

def test_archives_round_trip(frame):
    big, same = "é" * 200_000, "x" * 1000
    pages = [(1, "http://a/1", same, "u"), (2, None, same, "u"), (3, "http://a/ñ \n", "short", "u"), (4, "b", "short", "u"),
             (5, "c", None, "u"), (6, "d", big, "u"), (7, "e", "WARC/1.1\r\n\r\n" * 5, "u"), (None, "f", same, "u"), (2, None, same, "u")]
    chunks = archive_pages(frame(pages, "page_id long, url string, html string, payload string"), chunk=4096).collect()
    last = [(r["record_id"], r["bytes_so_far"] if r["record_type"] == "response" else r["payload_bytes"], r["digest_so_far"],
             r["record_type"], r["refers_to"]) for r in chunks if r["is_last"]]

    def expect(key, text, refers=None):
        body = (text or "").encode()
        return key, len(body), hashlib.sha1(body).hexdigest(), "revisit" if refers else "response", refers

    assert sorted(last, key=str) == sorted([
        expect("1", same, "2"), expect("2", same), expect("2", same), expect(None, same, "2"), expect("3", "short"),
        expect("4", "short"), expect("5", ""), expect("6", big), expect("7", "WARC/1.1\r\n\r\n" * 5)], key=str)
    parts = sorted((r for r in chunks if r["record_id"] == "6"), key=lambda r: r["chunk_no"])
    assert b"".join(bytes(r["chunk"]) for r in parts) == big.encode() and max(len(r["chunk"]) for r in parts) <= 4096
    sha = hashlib.sha1()
    for r in parts:
        sha.update(r["chunk"])
        assert r["digest_so_far"] == sha.hexdigest()


def test_archives_of_nothing(frame):
    assert archive_pages(frame([], "page_id long, url string, html string")).collect() == []


# ---- templates

def test_templates_are_found_with_their_spans(frame):
    notice = LICENSE_NOTICES["mit-notice"]
    damaged = notice.replace("without restriction, ", "with no limit at all ").replace("copies of", "copies")
    filler = sentences(2, 3)
    texts = [f"{filler[0]} {notice}\n{filler[1]}", f"{filler[1]} {damaged.upper()}", filler[2], None, "",
             "Released under the MIT License. " * 3, "the MIT license and the Apache license"]
    out = scan_templates(incidents(frame, texts)).collect()
    spans = defaultdict(list)
    for r in out:
        spans[r["ln_folio_incidencia"], r["template"]].append((r["span_start"], r["span_end"], r["coverage"]))
    start, end, coverage = spans["F0000", "mit-notice"][0]
    assert texts[0][start:end] == notice and coverage == 1.0
    start, end, coverage = spans["F0001", "mit-notice"][0]
    assert 0.8 <= coverage < 1 and texts[1][start:end] == damaged.upper()
    assert len(spans["F0005", "mit-line"]) == 3
    assert {k for k, _ in spans} == {"F0000", "F0001", "F0005"}
    assert scan_templates(incidents(frame, [])).collect() == []


def test_alignment_is_the_longest_common_run():
    rng = random.Random(3)
    for _ in range(50):
        left = [rng.randrange(50) for _ in range(20)]
        right = left[:8] + [99, 98] + left[8:15] + left[16:]
        assert len(align(np.array(left), np.array(right), 0)) >= 17
    assert winnow(np.array([3, 1, 1, 2], np.uint64)).tolist() == [1, 2]


# ---- tokens

HARD = ["", " ", "it's 'S  's   '", "a\r\n\r\n b\t\tc  ", "\x1c\x1d a\x1fb", "\x85\xa0 x  y", "é ½²x", "😀👍🏽", "\x00\x00",
        "<|endoftext|>", "ab" * 400, "   x" * 50]


@pytest.fixture(scope="module")
def tiktoken_encoding():
    return encoding(public_tokenizers.path("byte_bpe_50k.json"))


def test_bpe_agrees_with_the_library(frame, tiktoken_encoding):
    texts = [*HARD, None, *sentences(4, 20), sentences(5, 1, 20_000)[0]]
    for r, text in zip(sorted(encode_and_decode(incidents(frame, texts)).collect()), texts, strict=True):
        ids = tiktoken_encoding.encode_ordinary(text or "")
        assert r["ids"] == ids and r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256((text or "").encode()).hexdigest()
    assert encode_and_decode(incidents(frame, [])).collect() == []


def test_words_are_forgotten_in_time(monkeypatch, tiktoken_encoding):
    import granero.llm.byte_bpe as module

    monkeypatch.setattr(module, "REMEMBERED", 5)
    monkeypatch.setattr(module, "WORDS_AT_ONCE", 7)
    codec = Codec(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    for text in sentences(6, 5):
        assert codec.encode([text])[0].tolist() == tiktoken_encoding.encode_ordinary(text)


def test_ids_are_those_of_the_tokenizers_library():
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    special = ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|><|endoftext|> ", "<|endoftext|", "<<|endoftext|>> é\n<|endoftext|>1"]
    for text in HARD + special + sentences(7, 20):
        assert ids_of(text, path).tolist() == library.encode(text, add_special_tokens=False).ids
    assert 50256 in ids_of(special[0], path) and not len(ids_of(None, path))


# ---- toxicity

def test_toxic_words_are_learnt(frame):
    texts, labels, rng = sentences(8, 400, 60), {}, random.Random(8)
    for i in range(400):
        if i % 4 == 0:
            words = texts[i].split()
            words.insert(rng.randrange(60), rng.choice(["zoquete", "inútil"]))
            texts[i] = " ".join(words)
        labels[f"F{i:04d}"] = int(i % 4 == 0)
    texts += [None, "", "zoquete", texts[1]]
    reports = incidents(frame, texts).withColumnsRenamed({"ln_folio_incidencia": "hash_respuesta", "descripcion": "observaciones"})
    known = frame([(k, v) for k, v in labels.items() if int(k[1:]) < 300] + [(None, 1), ("F0001", None), ("F9999", 1)],
                  "hash_respuesta string, toxica int")
    out = {r["hash_respuesta"]: r for r in score_toxicity(reports, known).collect()}
    assert len(out) == len(texts)
    held = [k for k in labels if int(k[1:]) >= 300]
    assert sum(out[k]["predicted"] == labels[k] for k in held) >= 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in out.values())
    assert out["F0400"]["score"] == out["F0401"]["score"] and out["F0400"]["predicted"] == 0 and out["F0402"]["predicted"] == 1
    assert out["F0403"]["score"] == out["F0001"]["score"]


def test_toxicity_without_labels(frame):
    reports = incidents(frame, ["a b", None]).withColumnsRenamed({"ln_folio_incidencia": "hash_respuesta", "descripcion": "observaciones"})
    known = frame([("F0000", 0)], "hash_respuesta string, toxica int")
    assert [r["score"] for r in score_toxicity(reports, known).collect()] == [0.0, 0.0]
    assert score_toxicity(reports.limit(0), known.limit(0)).collect() == []


def test_kneser_ney_by_plain_counting(frame):
    import granero.llm.toxicity as module

    rng = random.Random(22)
    stock = ["zoquete", "urea", "roto", "el", "muy"] + [f"w{i}" for i in range(25)]
    rows = [(i % 2, " ".join(rng.choices(stock[i % 2:], k=60))) for i in range(40)] + [(0, None), (1, "")]
    model = module.fit(frame(rows, "label int, text string"))
    places = model.places()

    def contexts(members):
        return {(v, w) for t in members for words in [module._words(t)] for v, w in zip(["", *words], words)}

    both = [contexts([t for k, t in rows if k == label]) for label in (0, 1)]
    counts = [Counter(w for _, w in c) for c in both]
    everything = sum(map(len, both)) + len(counts[0] | counts[1]) + 1
    assert set(places) == {w for c in counts for w, n in c.items() if n > module.DISCOUNT} == {w for w in counts[0] | counts[1]}
    for i in (0, 1, 7):
        text = module._words(rows[i][1])
        for own in (None, rows[i][0]):
            got = model.log_probabilities(np.array([places[w] for w in text]), own)
            for label in (0, 1):
                seen = counts[label] - Counter(w for _, w in contexts([rows[i][1]])) if label == own else counts[label]
                total, freed = sum(seen.values()), sum(min(n, module.DISCOUNT) for n in seen.values())
                for at, w in enumerate(text):
                    shared = (counts[0][w] + counts[1][w] + 1) / everything
                    assert np.exp(got[label][at]) == pytest.approx((max(seen[w] - module.DISCOUNT, 0) + freed * shared) / total)


def test_the_comparison_of_the_models_always_decides(frame):
    import granero.llm.toxicity as module

    texts = sentences(23, 60, 40)
    reports = frame([(i, t) for i, t in enumerate(texts)], "hash_respuesta int, observaciones string")
    for truth in ([i % 2 for i in range(60)], [int(i < 3) for i in range(60)]):  # labels without any ground
        _, (_, slope) = module._learn(reports, frame(list(enumerate(truth)), "hash_respuesta int, toxica int"), "hash_respuesta", "observaciones", "toxica", 8000)
        assert slope > 0


# ---- series

def test_nearest_series(frame):
    rng = random.Random(9)
    rows = [(f"C{i:03d}", [rng.randint(-40, 40) for _ in range(33)], i % 5 == 0, 1) for i in range(300)]
    rows += [(f"D{i:03d}", rows[0][1], False, 1) for i in range(40)]  # ties
    rows += [("E", None, True, 1), ("F", [1, None], True, 1), (None, [1] * 33, True, 1), ("G", [], True, 1), ("H", [5], None, 1)]
    data = frame(rows, "id_ceda_agricultura string, serie array<bigint>, es_consulta boolean, score int")
    got = sorted(tuple(r) for r in nearest_series(data, k=7, candidate_block=64, query_block=16).collect())
    usable = [(k, v + [0] * (33 - len(v)), q) for k, v, q, _ in rows if k and v is not None and None not in v]
    expect = []
    for k, v, q in usable:
        if q:
            scored = sorted((-sum(a * b for a, b in zip(v, w)), c) for c, w, _ in usable if c != k)[:7]
            expect += [(k, i + 1, c, -s) for i, (s, c) in enumerate(scored)]
    assert got == sorted(expect)
    assert nearest_series(data.limit(0)).collect() == []
    assert nearest_series(data.filter("not es_consulta")).collect() == []


# ---- dialogues

def test_every_speaker_sees_the_dialogue(frame):
    rows = [("A", 1, "ana", "hola", 7), ("A", 2, "bea", "sí", 7), ("A", 2, "bea", "sí", 7), ("A", 3, None, None, 7), ("A", None, "ana", "inicio", 7),
            ("B", 1, "ana", "sola", 7), (None, 1, "eva", "x", 7)]
    data = frame(rows, "id_ceda_agricultura string, fecha_y_hora int, quien_reporta string, observaciones string, start int")
    out = defaultdict(list)
    for r in rotate_perspectives(data).collect():
        out[r["id_ceda_agricultura"], r["perspective"]].append(r)
    assert set(out) == {("A", "ana"), ("A", "bea"), ("A", "unnamed"), ("B", "ana"), (None, "eva")}
    turns = [("ana", "inicio"), ("ana", "hola"), ("bea", "sí"), ("bea", "sí"), ("unnamed", "")]
    for view in ("ana", "bea", "unnamed"):
        seen = sorted(out["A", view], key=lambda r: r["start"])
        text = "".join(r["segment"] for r in seen)
        assert text == "".join(f"<|assistant|>\n{t}<|end|>\n" if s == view else f"<|user|>\n{s}: {t}<|end|>\n" for s, t in turns)
        for r in seen:
            assert text[r["start"]:].startswith(r["segment"])
            if r["quien_reporta"] == view:
                assert text[r["mask_start"]:r["mask_end"]] == r["content"] + "<|end|>\n"
            else:
                assert r["mask_start"] is None and r["mask_end"] is None
    assert rotate_perspectives(data.limit(0)).collect() == []


# ---- packing

def optimum(items, capacity):
    best = len(items)

    def place(i, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if i == len(items):
            best = len(bins)
            return
        for k in {b: k for k, b in enumerate(bins)}.values():
            if bins[k] + items[i] <= capacity:
                place(i + 1, [*bins[:k], bins[k] + items[i], *bins[k + 1:]])
        place(i + 1, [*bins, items[i]])

    place(0, [])
    return best


def test_plans_are_optimal_on_small_histograms():
    rng = random.Random(10)
    for _ in range(150):
        capacity = rng.choice([10, 20, 50])
        items = sorted((rng.randint(1, capacity) for _ in range(rng.randint(1, 10))), reverse=True)
        plan = pack_histogram(Counter(items), capacity)
        assert Counter(s for f, n in plan for s in f * n) == Counter(items)
        assert all(sum(f) <= capacity for f, _ in plan)
        assert sum(n for _, n in plan) == optimum(items, capacity) <= sum(n for _, n in best_fit(Counter(items), capacity))


def test_pieces_are_packed_without_gaps(frame, tiktoken_encoding):
    texts = sentences(11, 60, 100) + [sentences(12, 1, 3000)[0], None, "", "a", "a"] + HARD
    out = pack_texts(incidents(frame, texts)).collect()
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in out:
        pieces[r["ln_folio_incidencia"]].append(r)
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for i, text in enumerate(texts):
        ids = np.array([*tiktoken_encoding.encode_ordinary(text or ""), 2], "<u4")
        found = sorted(pieces[f"F{i:04d}"], key=lambda r: r["piece"])
        assert [(r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in found] == [
            (k, s, n, zlib.crc32(ids[s:s + n].tobytes())) for k, (s, n) in enumerate(cut(len(ids), CAPACITY))]
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= CAPACITY
    assert len(sequences) == -(-sum(r["length"] for r in out) // CAPACITY)
    assert pack_texts(incidents(frame, [])).collect() == []


# ---- near copies

def shingle_set(text):
    words = WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))
    return frozenset(zip(*(words[k:] for k in range(4)))) if len(words) >= 4 else frozenset([tuple(words)]) if words else frozenset()


@pytest.mark.parametrize("group_rows", [2048, 6])
def test_near_copies_against_all_pairs(frame, group_rows):
    rng, texts = random.Random(13), []
    common = " ".join(f"paso{i}" for i in range(60))
    for base in sentences(14, 12, 70):
        for _ in range(rng.choice([1, 3, 9])):
            words = base.split()
            for _ in range(rng.choice([0, 1, 2, 3, 4, 6])):
                words[rng.randrange(len(words))] = rng.choice("xyzw") * 3
            texts.append(" ".join(words) + rng.choice(["", " " + common]))
    texts += [None, "", " ", "Uno dos", "uno DOS", "uno", texts[0], texts[0].upper()]
    sets = [shingle_set(t) for t in texts]
    group = list(range(len(texts)))
    for a in range(len(texts)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= 85 * (len(sets[a]) + len(sets[b]) - both):
                old, new = max(group[a], group[b]), min(group[a], group[b])
                group = [new if g == old else g for g in group]
    out = {r["ln_folio_incidencia"]: (r["n_shingles"], r["component_id"]) for r in near_copy_groups(incidents(frame, texts), group_rows=group_rows).collect()}
    assert out == {f"F{i:04d}": (len(sets[i]), f"F{group[i]:04d}") for i in range(len(texts))}
    assert len(set(group)) < len(texts) - 10


def test_near_copies_of_odd_rows(frame):
    text = sentences(15, 1)[0]
    out = near_copy_groups(incidents(frame, [text, text, text, text], ["b", "a", None, "b"])).collect()
    assert sorted((r["ln_folio_incidencia"] or "", r["component_id"] or "") for r in out) == [("", ""), ("a", "a"), ("b", "a"), ("b", "a")]
    assert near_copy_groups(incidents(frame, [])).collect() == []


def test_components_of_a_long_chain(frame):
    links = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 102), (100, 102), (7, 7)]
    out = {r["node"]: r["component"] for r in components(frame(links, "u long, v long")).collect()}
    assert out == {i: 0 for i in range(41)} | {100: 100, 101: 100, 102: 100}


# ---- language models

def test_losses_against_plain_counting(frame):
    texts = sentences(16, 12, 30) + [None, "", "uno", "uno dos uno dos"]
    target = [i % 3 == 0 for i in range(len(texts))]
    data = frame([(f"F{i:04d}", t, m, 0.0) for i, (t, m) in enumerate(zip(texts, target))],
                 "ln_folio_incidencia string, descripcion string, validada boolean, score double")
    read = [classes(t, {}) for t in texts]

    lengths = [len(r[0]) for r in read]
    matched = sum(n for n, m in zip(lengths, target) if m) / sum(lengths)

    def loss(i, members, weight=1.0):
        single, pair = read[i]
        words, pairs = Counter(), Counter()
        for j in members:
            if j != i:
                words.update(read[j][0].tolist())
                pairs.update(read[j][1].tolist())
        total, out = sum(words.values()), 0.0
        for k, w in enumerate(single.tolist()):
            share = (weight * words[w] + 1) / (weight * total + 2**WORD_BITS)
            if k:
                seen = weight * pairs[int(pair[k - 1])]
                share = (seen + SMOOTHING * share) / (max(weight * words[int(single[k - 1])], seen) + SMOOTHING)
            out -= np.log(share)
        return out / len(single)

    out = sorted(score_against_target(data).collect())
    for i, r in enumerate(out):
        assert r["n_tokens"] == len(read[i][0])
        if not r["n_tokens"]:
            assert r["score"] is None and r["target_loss"] is None
            continue
        near, far = loss(i, [j for j, m in enumerate(target) if m]), loss(i, range(len(texts)), matched)
        assert r["target_loss"] == pytest.approx(near) and r["background_loss"] == pytest.approx(far)
        assert r["score"] == pytest.approx(near - far)
    assert max(read[0][1]) < 2**PAIR_BITS
    assert score_against_target(data.limit(0)).collect() == []


def test_a_larger_background_shifts_no_score(frame):
    rng = random.Random(21)
    texts = [" ".join(rng.choices("urea roto el muy tarde dap bulto saldo".split(), k=90)) for _ in range(400)]
    schema = "ln_folio_incidencia int, descripcion string, validada boolean"
    once = [(i, t, i < 40) for i, t in enumerate(texts[:200])]
    before, after = ({r["ln_folio_incidencia"]: r["score"] for r in score_against_target(frame(rows, schema)).collect()}
                     for rows in (once, once + [(i + 200, t, False) for i, t in enumerate(texts[200:])]))
    assert max(abs(before[i] - after[i]) for i in range(200)) < 0.05
    assert abs(np.mean([before[i] - after[i] for i in range(200)])) < 0.005


def test_every_word_and_pair_has_its_own_count(frame, monkeypatch):
    """More distinct words than the 2**18 there were classes of; blocks and shares of counts are many."""
    import granero.llm.lm_scoring as module

    many, per = 300_000, 3_000
    texts = [" ".join(f"w{i}" for i in range(at, at + per)) for at in range(0, many, per)]
    single, pair = (np.concatenate(c) for c in zip(*(classes(t, {}) for t in texts)))
    assert len(np.unique(single)) == many and len(np.unique(pair)) == many - len(texts)
    monkeypatch.setattr(module, "SHARE_BYTES", 1 << 18)
    data = frame([(f"F{i:04d}", t, i % 2 == 0) for i, t in enumerate(texts)], "ln_folio_incidencia string, descripcion string, validada boolean")
    for r in score_against_target(data).collect():  # no word occurs in another text: nothing is left but the smoothing
        even = np.log((many - per) / 2 + many)  # the background weighs as much as the target, half of the texts
        assert r["background_loss"] == pytest.approx(even, rel=1e-9)
        own = int(r["ln_folio_incidencia"][1:]) % 2 == 0
        assert r["target_loss"] == pytest.approx(np.log(many / 2 - (per if own else 0) + many), rel=1e-9)


@pytest.mark.parametrize("group_rows", [512, 6])
def test_every_link_between_near_copies(frame, group_rows):
    rng, texts = random.Random(21), []
    for base in sentences(22, 3, 200):
        for _ in range(9):
            words = base.split()
            for _ in range(rng.choice([0, 1, 1, 2, 9])):
                words[rng.randrange(len(words))] = rng.choice("xyzw") * 3
            texts.append(" ".join(words))
    texts += [None, "", texts[0], texts[0].upper(), "uno dos"]
    sets = [shingle_set(t) for t in texts]
    n = len(texts)
    linked = {(a, b) for a in range(n) for b in range(n) if a != b and sets[a] and sets[b]
              and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])}
    docs, links = near_copy_links(incidents(frame, texts), group_rows=group_rows)
    out = {int(r["ln_folio_incidencia"][1:]): r for r in docs.collect()}
    assert {i: r["n_links"] for i, r in out.items()} == {i: sum(a == i for a, _ in linked) for i in range(n)}
    pairs = [frozenset((r["u"], r["v"])) for r in links.collect()]
    assert len(pairs) == len(set(pairs)) and set(pairs) == {
        frozenset((out[a]["class_id"], out[b]["class_id"])) for a, b in linked if sets[a] != sets[b]}
    assert len(pairs) > len({s for s in sets if s})  # more than a forest
    groups = {r["ln_folio_incidencia"]: r["component_id"] for r in near_copy_groups(incidents(frame, texts)).collect()}
    assert groups == {r["ln_folio_incidencia"]: r["component_id"] for r in out.values()}


# ---- texts in blocks

@pytest.mark.parametrize("values", [[], [0, 0], [1], [255, 256, 0], [2**40, 3, 2**63], list(range(5000)), [7] * 3000])
def test_numbers_come_back_as_they_were(values):
    numbers = np.array(values, np.uint64)
    packed = squeeze(numbers)
    assert expand(packed, len(numbers)).tolist() == values
    assert len(packed) <= 36 + 8 * len(numbers)
    if values == [7] * 3000:
        assert len(packed) < 100  # small numbers that repeat take next to nothing


def test_words_of_a_share_take_fewer_bytes():
    """A million words over 32 shares of 25 blocks: the hashes took 5 bytes each."""
    from granero.llm.lm_scoring import _limits, _pack_hashes, _unpack_hashes

    hashes, limits = np.unique(np.random.default_rng(1).integers(0, 2**63, 800_000, np.uint64)), _limits(32)
    ends = [*np.searchsorted(hashes, np.array(limits, np.uint64)).tolist(), len(hashes)]
    packed = [_pack_hashes(hashes[lo:hi], limits[i], 32) for i, (lo, hi) in enumerate(zip(ends, ends[1:]))]
    assert sum(map(len, packed)) < 3.6 * len(hashes)
    for i, (lo, hi) in enumerate(zip(ends, ends[1:])):
        back = _unpack_hashes(packed[i], hi - lo)
        assert len(np.unique(back)) == hi - lo and (np.diff(back.astype(np.int64)) > 0).all() and int(back.max()) < 2**41


def test_targets_by_key_score_like_a_column(frame, monkeypatch):
    """Null, repeated and unknown keys among the targets and the rows, several blocks; the texts are in no join."""
    import granero.llm.text_blocks as module

    monkeypatch.setattr(module, "BLOCK_BYTES", 3000)
    texts = sentences(31, 60, 40) + [None, "", "é x", "é x"]
    keys = [i if i % 9 else None for i in range(62)] + [5, 5]
    good = [k for k in range(0, 62, 3)] + [5, 5, None, 999]
    schema = "ln_folio_incidencia int, descripcion string, validada boolean"
    data = frame([(k, t, k is not None and k in good) for k, t in zip(keys, texts)], schema)
    by_key = score_against_target(data.drop("validada"), targets=frame([(k,) for k in good], "doc int"))
    assert sorted(by_key.collect(), key=str) == sorted(score_against_target(data).collect(), key=str)
    marked = module.store_marks(module.store_blocks(data.select("ln_folio_incidencia", "descripcion")), frame([(k,) for k in good], "doc int"))
    assert marked.count() > 2


def test_sets_are_taken_from_marked_texts(frame):
    """Every text of a repeated key, none of a null key; the texts are in no join (the frame was joined with the keys)."""
    from granero.llm.near_copies import _stored_sets

    texts = sentences(41, 40, 60) + [None, "", "uno dos"]
    keys = list(range(40)) + [None, 41, 3]
    rows = frame(list(zip(keys, texts)), "_key int, _text string")
    got = sorted((r["rep"], r["n"]) for r in _stored_sets(rows, frame([(3,), (3,), (7,), (41,), (None,), (500,)], "rep int"), 4).collect())
    assert got == sorted([(3, len(shingle_set(texts[3]))), (3, 1), (7, len(shingle_set(texts[7]))), (41, 0)])


def test_no_join_of_near_copies_holds_a_text(frame, monkeypatch):
    import granero.llm.near_copies as module

    sent, join = [], DataFrame.join

    def watched(self, other, *rest, **named):
        sent.append({*self.columns, *other.columns})
        return join(self, other, *rest, **named)

    monkeypatch.setattr(DataFrame, "join", watched)
    texts = sentences(42, 12, 60)
    out = module.near_copy_groups(incidents(frame, texts + [texts[0] + " x", texts[0]])).collect()
    monkeypatch.undo()
    assert sent and not any("_text" in columns for columns in sent)
    assert {r["component_id"] for r in out if r["ln_folio_incidencia"] in ("F0000", "F0012", "F0013")} == {"F0000"}
