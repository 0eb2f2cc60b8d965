"""Template text inside records: winnowed fingerprints find candidates, banded alignment measures them."""

from __future__ import annotations

import re
import zlib
from collections import defaultdict
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from granero.llm.common import map_arrow

TOKEN = re.compile(r"\w+")
GRAM, WINDOW = 3, 2  # any run of GRAM + WINDOW - 1 equal words is found
BAND = 8  # inserted or dropped words an alignment may drift by
MIN_COVERAGE = 0.8
MAX_TEMPLATE_WORDS = 200_000  # bound of the index that every task holds
MATCH, MISS, GAP = 2, -1, -1

# Licence notices as they are printed in works.
LICENSE_NOTICES: dict[str, str] = {
    "apache-2.0-line": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-notice":
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless "
        "required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
        "\"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    "cc-by-nc-4.0-line": "Licensed under CC BY-NC 4.0.",
    "gpl-3.0-line": "This work is licensed under the GNU General Public License, version 3.",
    "mit-line": "Released under the MIT License.",
    "mit-notice":
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "Software, and to permit persons to whom the Software is furnished to do so",
}


def _hashes(words: list[str], seen: dict[str, int]) -> np.ndarray:
    """Hashes of the words in lower case; `seen` remembers those of the batch."""
    return np.fromiter((seen[w] if w in seen else seen.setdefault(w, zlib.crc32(w.lower().encode("utf-8", "surrogatepass")))
                        for w in words), dtype=np.uint64, count=len(words))


def grams(hashes: np.ndarray, k: int = GRAM) -> np.ndarray:
    """Hash of every run of k words."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for j in range(k):
        out = (out ^ hashes[j:j + n]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return out


def winnow(values: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Places of the minimum of every window, the rightmost on ties."""
    if not len(values):
        return np.zeros(0, np.int64)
    n = max(1, len(values) - window + 1)
    view = np.lib.stride_tricks.sliding_window_view(values, min(window, len(values)))
    back = view.shape[1] - 1 - np.argmin(view[:, ::-1], axis=1)
    return np.unique(np.arange(n) + back)


def align(left: np.ndarray, right: np.ndarray, shift: int, band: int = BAND) -> list[tuple[int, int]]:
    """Pairs of equal words of the best local alignment of `left` and `right` near the diagonal right = left + shift.

    Only cells within `band` of the diagonal are filled: memory and work follow the template's length.
    """
    width = 2 * band + 1
    above, best, at, steps = [0] * (width + 2), 0, None, []
    n = len(right)
    for i, word in enumerate(left):
        row, moves = [0] * (width + 2), bytearray(width + 2)
        for b in range(1, width + 1):
            j = i + shift + b - 1 - band
            if not 0 <= j < n:
                continue
            same = right[j] == word
            value, move = above[b] + (MATCH if same else MISS), 1
            if above[b + 1] + GAP > value:
                value, move = above[b + 1] + GAP, 2  # a template word is missing
            if row[b - 1] + GAP > value:
                value, move = row[b - 1] + GAP, 3  # a word was put in
            if value > 0:
                row[b], moves[b] = value, move
                if value > best:
                    best, at = value, (i, b)
        steps.append(moves)
        above = row
    pairs = []
    while at is not None:
        i, b = at
        move = steps[i][b] if i >= 0 else 0
        if not move:
            break
        j = i + shift + b - 1 - band
        if move == 1:
            if left[i] == right[j]:
                pairs.append((i, j))
            at = (i - 1, b)
        elif move == 2:
            at = (i - 1, b + 1)
        else:
            at = (i, b - 1)
    return pairs[::-1]


def _scanner(templates: Mapping[str, str], min_coverage: float, band: int, key_type: pa.DataType):
    names = list(templates)
    seen: dict[str, int] = {}
    bodies = [_hashes(TOKEN.findall(templates[n]), seen) for n in names]
    index = defaultdict(list)  # fingerprint -> (template, place)
    for t, body in enumerate(bodies):
        values = grams(body)
        for p in winnow(values):
            index[int(values[p])].append((t, int(p)))
    known = np.array(sorted(index), dtype=np.uint64)
    schema = pa.schema([("_key", key_type), ("template", pa.string()), ("coverage", pa.float64()),
                        ("matched_words", pa.int64()), ("span_start", pa.int64()), ("span_end", pa.int64())])

    def found_in(text: str, memory: dict[str, int]) -> Iterator[tuple]:
        words = _hashes(TOKEN.findall(text), memory)
        values = grams(words)
        picked = winnow(values)
        picked = picked[np.isin(values[picked], known)] if len(picked) else picked
        if not len(picked):
            return
        places = list(TOKEN.finditer(text))
        hits = defaultdict(set)  # template -> diagonals
        for p in picked.tolist():
            for t, q in index[int(values[p])]:
                hits[t].add(p - q)
        for t, diagonals in sorted(hits.items()):
            body, free = bodies[t], 0  # words before `free` are taken
            for d in sorted(diagonals):
                if d < free - band:
                    continue
                base = max(free, d - band)
                pairs = align(body, words[base:max(base, d + len(body) + band)], d - base, band)
                if pairs and len(pairs) >= min_coverage * len(body):
                    first, last = base + pairs[0][1], base + pairs[-1][1]
                    free = last + 1
                    yield names[t], len(pairs) / len(body), len(pairs), places[first].start(), places[last].end()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            memory, keys, rows = {}, [], []
            for key, text in zip(batch.column(0), batch.column(1)):
                for row in found_in(text.as_py() or "", memory):
                    keys.append(key.as_py())
                    rows.append(row)
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(keys, key_type), *[
                    pa.array(c, f.type) for c, f in zip(zip(*rows), list(schema)[1:])]], schema=schema)
    return scan


def scan_templates(records: DataFrame, templates: Mapping[str, str] = LICENSE_NOTICES, key: str = "ln_folio_incidencia",
                   text: str = "descripcion", *, min_coverage: float = MIN_COVERAGE, band: int = BAND) -> DataFrame:
    """Where an incident's `descripcion` repeats a template: one row per record, template and place.

    `coverage` is the share of the template's words found in order, `span_start` and `span_end` the characters from the
    first to the last of them. Candidates share a winnowed fingerprint with the template; each is aligned word by word
    inside a band. Places of one template do not overlap. A map-only step: every task holds the templates' index, whose
    size is checked against `MAX_TEMPLATE_WORDS`.

    Words are runs of letters, digits and `_`, lower-cased. Null and empty texts give no rows, null keys are kept,
    repeated rows give repeated rows; other columns are ignored; an empty table or no templates give no rows.
    """
    from pyspark.sql.pandas.types import to_arrow_type

    size = sum(len(TOKEN.findall(t)) for t in templates.values())
    if size > MAX_TEMPLATE_WORDS:
        raise ValueError(f"templates of {size} words; at most {MAX_TEMPLATE_WORDS}")
    if any(len(TOKEN.findall(t)) < GRAM + WINDOW - 1 for t in templates.values()):
        raise ValueError(f"a template needs {GRAM + WINDOW - 1} words")
    kind = records.schema[key].dataType
    schema = T.StructType([
        T.StructField("_key", kind), T.StructField("template", T.StringType()), T.StructField("coverage", T.DoubleType()),
        T.StructField("matched_words", T.LongType()), T.StructField("span_start", T.LongType()),
        T.StructField("span_end", T.LongType())])
    source = records.select(F.col(key).alias("_key"), F.col(text).cast("string").alias("_text"))
    return map_arrow(source, _scanner(templates, min_coverage, band, to_arrow_type(kind)), schema).withColumnRenamed("_key", key)
