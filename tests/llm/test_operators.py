"""Every operator against plain loops on awkward rows: nulls, empty and long texts, ties, repeated rows, clashing names."""

import collections
import hashlib
import random
import time
import zlib

import brute
import duckdb
import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from papyrine.llm import bpe, exact, html, licences, packing, prefix_counts, quality, sharding, simhash, suffix

DOCUMENT = ["doc_id", "text", "lang", "source", "n_chars"]


def key(row):
    return tuple((x is not None, x) for x in row)


def collected(df):
    return sorted((tuple(r) for r in df.collect()), key=key)


def library_ids(rows, path):
    library = bpe.encoder(path).library
    return library, [e.ids for e in library.encode_batch([r[1] or "" for r in rows], add_special_tokens=False)]


def test_bpe_round_trip(docs, rows):
    library, ids = library_ids(rows, bpe.WORD_BPE)
    decoded = [library.decode(i, skip_special_tokens=False) for i in ids]
    whole = [(r[0], i, d) for r, i, d in zip(rows, ids, decoded, strict=True)]
    assert collected(bpe.encode_decode(docs)) == sorted(whole, key=key)

    def digest(text):
        return hashlib.sha256(text.encode()).hexdigest()

    wanted = [(d, len(i), digest(" ".join(map(str, i))), digest(t)) for d, i, t in whole]
    assert collected(bpe.digests(docs)) == sorted(wanted, key=key)


def test_segment_trees_agree():
    model = bpe.encoder(bpe.WORD_BPE)
    words = [w.encode() for w in ["strawberries", "aaaa", "ß", "internationalisation", "x" * 63, "ababababab" * 6, "日本"]]
    for word, ids in zip(words, model.encode_many(words), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == model.encode_symbols(model.symbols(word).tolist())


def test_token_counts(docs, rows):
    _, ids = library_ids(rows, prefix_counts.BYTE_BPE)
    wanted = [(r[0], len(brute.raw(r[1])), len(i), len(i) > 1024) for r, i in zip(rows, ids, strict=True)]
    assert collected(prefix_counts.token_counts(docs)) == sorted(wanted, key=key)


_PIECES = ["a", "b", " ", "  ", "\n", "'s", "'re", "'ll", "é", "the", " the", "12", "!", "<|endoftext|>", "\t", "中", "　"]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from(_PIECES), max_size=12).map("".join), st.integers(0, 8))
def test_every_prefix(text, budget):
    own = prefix_counts.counter(prefix_counts.BYTE_BPE)
    library = own.encoder.library
    counts = own.prefix_counts(text)
    wanted = [len(library.encode(text[:i], add_special_tokens=False).ids) for i in range(len(text) + 1)]
    assert [counts[len(text[:i].encode())] for i in range(len(text) + 1)] == wanted
    assert own.truncate(text, budget) == text[: max(i for i, n in enumerate(wanted) if n <= budget)]


def test_quality_measures(docs, rows):
    found = {tuple(r)[:-1]: r["kept"] for r in quality.verdicts(docs).drop("host", "base_failed", "n_lines").collect()}
    for doc_id, text, *_ in rows:
        words = brute.WORD.findall(brute.raw(text))
        grams = collections.Counter(zip(words, words[1:], words[2:], strict=False))
        places = {i + k for i, g in enumerate(zip(words, words[1:], words[2:], strict=False)) if grams[g] > 1 for k in range(3)}
        lines = [x for x in brute.raw(text).split(b"\n") if brute.WORD.search(x)]
        row = (doc_id, len(words), sum(len(w.decode()) for w in words), sum(c in "#*$%&|<>" for c in text or ""))
        row = (*row, len(lines) - len(set(lines)), len(places))
        assert row in found
        if len(words) < 50 or 100 * len(places) > 50 * len(words):
            assert found[row] is False


def test_hosts_are_shrunk(spark):
    good, bad = " ".join(f"word{i}" for i in range(80)), " ".join(f"#{i}%" for i in range(80))
    data = [(i, bad if i % 10 < 8 else good, "x", "worse") for i in range(100)]
    data += [(1000 + i, bad if i % 50 == 0 else good, "x", f"host{i % 40}") for i in range(4000)]
    data += [(9000, bad, "x", "single")]
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string, source string")
    out = {r["doc_id"]: r["kept"] for r in quality.verdicts(docs).collect()}
    # The bad host is strict; one bad page proves nothing of its host; clean documents stay everywhere.
    assert not any(out[i] for i in range(100) if i % 10 < 8)
    assert out[9000] and all(out[i] for i in out if i >= 1000)
    assert all(out[i] for i in range(100) if i % 10 >= 8)
    assert quality.keep_good(docs).count() == sum(out.values())


def test_exact_groups(docs, rows):
    import re

    texts = collections.defaultdict(list)
    for doc_id, text, *_ in rows:
        texts[re.sub(r"[\x20\x09-\x0D]+", " ", text or "")].append(doc_id)
    wanted = []
    for text, ids in texts.items():
        keep = min((i for i in ids if i is not None), default=None)
        once = set()
        for i in ids:
            wanted.append((i, keep, len(ids), i == keep and not once, hashlib.sha256(text.encode()).hexdigest()))
            if i == keep:
                once.add(i)
    assert collected(exact.groups(docs)) == sorted(wanted, key=key)
    left = exact.deduplicate(docs)
    assert left.columns == docs.columns
    assert left.count() == len(texts)


def test_filters_merge_without_loss():
    rng = np.random.default_rng(3)
    values = rng.integers(0, 2**63, 5000).astype(np.uint64) * np.uint64(2)
    values = np.concatenate([values, values[:900], np.repeat(values[:1], 700)])
    parts = [exact.CountingQuotientFilter.build(p) for p in np.array_split(values, 7)]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.merge(exact.CountingQuotientFilter.from_bytes(part.to_bytes()))
    distinct, counts = np.unique(values, return_counts=True)
    assert np.array_equal(whole.fingerprints(), distinct)
    assert np.array_equal(whole.counts, counts.astype(np.uint64))


def test_shards(docs, rows):
    out = sharding.shards(docs, bucket_parts=16).collect()
    sizes = sorted((len(brute.raw(r[1])) + 1, brute.crc(brute.raw(r[1]))) for r in rows)
    assert sorted((r["size"], r["text_crc32"]) for r in out) == sizes
    shard_of, slots = {}, collections.defaultdict(list)
    for r in out:
        assert shard_of.setdefault((r["size"], r["text_crc32"]), r["shard"]) == r["shard"]
        slots[r["shard"]].append(r["slot"])
        assert (r["law"], r["grown_shard"]) == ("bytes", None)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 1000), min_size=1, max_size=60))
def test_differencing(sizes):
    sums, places = sharding.difference([[s, 0, 0, 0] for s in sizes])
    loads = [0] * 4
    for size, place in zip(sizes, places, strict=True):
        assert sorted(place) == [0, 1, 2, 3]
        loads[place[0]] += size
    assert loads == sums and sums[0] - sums[-1] <= max(sizes)


def test_passages(docs, rows):
    by_id = [r for r in rows if r[0] not in (None, 5)]
    shared = docs.filter("doc_id is not null and doc_id <> 5")
    assert collected(suffix.digests(shared)) == sorted(brute.removed([r[:2] for r in by_id]), key=key)
    # Null ids come first, rows that share an id go by a hash of their text, repeated rows lose the same.
    out = collected(suffix.digests(docs))
    assert len(out) == len(rows)
    assert [r[2] for r in out if r[0] is None] == [0, 0]
    cut = suffix.remove_repeats(docs)
    assert cut.columns == docs.columns and cut.count() == len(rows)


def test_common_line_in_many_surroundings(spark):
    rng = np.random.default_rng(5)

    def noise(n):
        return "".join(rng.choice(list("abcdefgh ä"), n))

    short, long = noise(60), noise(170)
    own = [noise(90) for _ in range(6)]
    rows = [(i, f"{noise(80)}{short}{own[i % 6]}{noise(60)}{long}{noise(80)}") for i in range(40)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    wanted = sorted(brute.removed(rows), key=key)
    assert collected(suffix.digests(frame)) == wanted
    assert collected(suffix.digests(frame, hot_stretches=5)) == wanted
    assert collected(suffix.digests(frame, hot_stretches=0)) == wanted


def test_rows_of_one_id_do_not_share_anchors(spark, monkeypatch):
    rng = random.Random(11)
    words = ["".join(rng.choices("abcdefghä", k=7)) for _ in range(400)]
    passage = " ".join(rng.choices(words, k=40))
    texts = [" ".join([*rng.choices(words, k=30), passage, *rng.choices(words, k=30)]) for _ in range(60)]
    rows = [(None if i % 2 else 7, text) for i, text in enumerate(texts)] + [(7, texts[0])] * 30
    sent = []

    def watched(df, step, schema, run=suffix.common.map_partitions):
        if getattr(step, "func", None) is suffix.cut_stretches:
            sent.extend((len(r["text"].encode()), len(r["spans"])) for r in df.select("text", "spans").collect())
        return run(df, step, schema)

    monkeypatch.setattr(suffix.common, "map_partitions", watched)
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    found = collections.Counter(tuple(r) for r in suffix.digests(frame).collect())
    assert len(sent) == len(rows) and all(8 * spans <= size for size, spans in sent)
    # Rows of an id come in the order of their texts' hashes, null ids first; equal rows are one document.
    order = sorted({(d is not None, suffix.xxhash.xxh64_intdigest(t, seed=42) + (1 << 63) & (1 << 64) - 1, t) for d, t in rows})
    wanted = {(known, t): w for (known, _, t), w in zip(order, brute.removed([(i, t) for i, (*_, t) in enumerate(order)]), strict=True)}
    assert found == collections.Counter((d, *tuple(wanted[d is not None, t])[1:]) for d, t in rows)


def test_stretches_of_a_hash_are_counted():
    line = b"the same line in all texts, so long that most strings around it find their anchor within it;"
    texts = [bytes([65 + i]) * 80 + line + bytes([97 + i]) * 80 for i in (0, 1, 2, 2)]
    batch = pa.RecordBatch.from_pydict({"doc_id": [1, 2, 3, 4], "text": [t.decode() for t in texts]})
    apart = [*suffix.find_anchors(iter([batch.slice(0, 3)]), 1), *suffix.find_anchors(iter([batch.slice(3)]), 1)]
    (found,) = suffix.repeated_anchors(iter(apart))
    count = collections.Counter()
    for gram, n in zip(found["hash"].to_pylist(), found["stretches"].to_pylist(), strict=True):
        count[gram] = max(count[gram], n)
    assert 3 in count.values() and max(count.values()) == 3


@settings(max_examples=100, deadline=None)
@given(st.text("ab", max_size=40))
def test_longest_previous_factor(text):
    order = sorted(range(len(text)), key=lambda i: text[i:])

    def common(i, j):
        n = 0
        while max(i, j) + n < len(text) and text[i + n] == text[j + n]:
            n += 1
        return n

    prefix = [0, *(common(a, b) for a, b in zip(order, order[1:], strict=False))]
    wanted = [max((common(i, j) for j in range(i)), default=0) for i in order]
    assert suffix.longest_previous(order, prefix[: len(order)]) == wanted


def test_near_duplicates(docs, rows):
    prints = [(r[0], brute.simhash(r[1])) for r in rows]
    wanted = [(d, format(p, "016x"), c) for (d, p), c in zip(prints, brute.near_components(prints), strict=True)]
    assert collected(simhash.near_duplicates(docs)) == sorted(wanted, key=key)
    left = simhash.deduplicate(docs)
    assert left.columns == docs.columns
    assert {r["doc_id"] for r in left.collect()} == {c for _, _, c in wanted}


def test_links_of_split_buckets(spark):
    rng = np.random.default_rng(1)
    centre = int(rng.integers(0, 2**62))
    near = [centre ^ sum(1 << int(b) for b in rng.choice(64, 3, replace=False)) for _ in range(200)]
    prints = np.unique(np.array([*near, *rng.integers(0, 2**63, 200)], np.uint64))
    frame = spark.createDataFrame([(int(p),) for p in prints.view(np.int64)], "fp long")
    root = {r["node"]: r["root"] for r in simhash.components(simhash.links(frame, len(prints), 20_000)).collect()}
    label = brute.near_components([(i, int(p)) for i, p in enumerate(prints)])
    groups = collections.defaultdict(set)
    for p, own in zip(prints.view(np.int64).tolist(), label, strict=True):
        groups[own].add(root.get(p, p))
    assert all(len(g) == 1 for g in groups.values()) and len(set().union(*groups.values())) == len(groups)


def test_packing(docs, rows):
    _, ids = library_ids(rows, bpe.WORD_BPE)
    wanted = collections.Counter((r[0], tuple([*i, packing.END_ID])) for r, i in zip(rows, ids, strict=True))
    pieces, sequences = collections.defaultdict(list), collections.defaultdict(list)
    for r in packing.pack(docs, length=512, with_ids=True).collect():
        raw = bytes(r["ids"])
        assert zlib.crc32(raw) == r["ids_crc32"] and len(raw) == 4 * r["length"] > 0
        pieces[r["doc_id"], r["doc_tokens"]].append((r["sequence_id"], r["offset"], r["start"], raw))
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for spans in sequences.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at == 512 or at & (at - 1) == 0
    # Pieces of a document follow each other along the curve.
    found: collections.Counter = collections.Counter()
    for (doc_id, total), own in pieces.items():
        whole = np.frombuffer(b"".join(raw for *_, raw in sorted(own)), "<u4").tolist()
        for at in range(0, len(whole), total):
            found[doc_id, tuple(whole[at : at + total])] += 1
    assert found == wanted


def test_hilbert_curve_steps_to_neighbours():
    grid = np.stack(np.meshgrid(*[np.arange(8)] * 3), -1).reshape(-1, 3)
    keys = packing.hilbert_keys(grid, 3)
    assert sorted(keys.tolist()) == list(range(512))
    along = grid[np.argsort(keys)]
    assert (np.abs(np.diff(along, axis=0)).sum(axis=1) == 1).all()


def test_budgets_from_stored_counts(spark, tmp_path):
    """Truncation and prefix counts of a stored table against the library on every prefix, without any encoding."""
    library = prefix_counts.counter(prefix_counts.BYTE_BPE).encoder.library
    data = [(1, "It's  a \u00e9t\u00e9 \U0001f642\U0001f642 of\n\n words, they've 1234!"), (2, None), (None, ""), (None, "<|endoftext|> x "), (1, "uncharacteristically")]
    path = str(tmp_path / "counts")
    prefix_counts.prefix_table(spark.createDataFrame(data, "doc_id long, text string")).write.parquet(path)
    stored = spark.read.parquet(path)
    counts = [[len(library.encode(t[:k], add_special_tokens=False).ids) for k in range(len(t) + 1)] for t in (x or "" for _, x in data)]
    for budget in (0, 1, 2, 5, 9, 1000):
        wanted = []
        for (i, text), own in zip(data, counts, strict=True):
            k = max(k for k, n in enumerate(own) if n <= budget)
            wanted.append((i, (text or "")[:k], own[k]))
        found = prefix_counts.truncated(stored, budget)
        assert sorted(map(key, wanted)) == sorted(key(r) for r in found.collect())
        assert "Arrow" not in found._jdf.queryExecution().toString()
        heads = [(i, own[min(budget, len(own) - 1)]) for (i, _), own in zip(data, counts, strict=True)]
        assert sorted(map(key, heads)) == sorted(key(r) for r in prefix_counts.prefix_tokens(stored, budget).collect())
    assert prefix_counts.truncated(stored, -1).collect() == []


def test_main_text(spark):
    page = (
        "<html><head><title>T</title><script>var a = '<p>no</p>';</script></head><body><nav><ul><li><a href=/>Home</a></ul></nav>"
        "<article><h1>A &amp; B</h1><p>First\n  <b>bold</b> text&nbsp;here, long enough to be read.<p>Second<br>line&#33;</article>"
        "<div class=comments><p>I do not agree with that.</p></div><form><p>Your mail</p></form><footer>All rights</footer>"
    )
    data = [(1, "u", page), (2, None, None), (None, "v", ""), (4, "w", "<p"), (5, "x", "plain"), (1, "u", page)]
    pages = spark.createDataFrame(data, "page_id long, url string, html string")
    out = {r["page_id"]: r for r in html.extract(pages).collect()}
    assert out[1]["text"] == "A & B\nFirst bold text here, long enough to be read.\nSecond line!"
    assert out[1]["n_chars"] == len(out[1]["text"])
    assert out[2]["text"] == out[None]["text"] == ""
    assert html.extract(pages).count() == len(data)
    assert html.extract(pages.limit(0), html.fit(pages)).collect() == []


def test_main_text_loses_nothing_by_rule():
    """Loose text, a page inside a form, formulas and objects are read; what a form asks for is not."""
    counts = collections.Counter()
    for layout in html.LAYOUTS:
        counts.update({k: n * html.LAYOUT_WEIGHT for k, n in html.Page(layout).counts().items()})
    model = html.Model(counts)
    first, second = "Several sentences of the text, long enough to be read.", "Another paragraph of the same text, with more words."
    asked = "<form><p>Leave a reply, please.</p><label>Name</label><input><textarea></textarea><button>Post</button></form>"
    pages = {
        f"{first} {second}": f"{first} {second}",
        f"<html><body>{first}<p>{second}</p>{first}</body></html>": f"{first}\n{second}\n{first}",
        f"<body><form><div><h1>Title</h1><p>{first}</p><p>{second}</p></div><input type='hidden'></form></body>": f"Title\n{first}\n{second}",
        f"<article><p>{first} If <math><mi>x</mi></math> is <object>here</object>, then.</p></article>": f"{first} If x is here, then.",
        f"<body><article><h1>Title</h1><p>{first}</p>{asked}</article>{asked}</body>": f"Title\n{first}",
        f"<body><div class='content'><p>{first}</p></div><div id='comments'><div><div><p>{second}</p></div></div></div></body>": first,
    }
    assert {page: model.text(page) for page in pages} == pages


def test_layouts_are_held_out():
    import re

    for i, layout in enumerate(html.LAYOUTS):
        counts = collections.Counter()
        for other in html.LAYOUTS[:i] + html.LAYOUTS[i + 1 :]:
            counts.update(html.Page(other).counts())
        page = html.Page(re.sub(r" data-main='.'", "", layout))
        marginals, labels = html.Model(counts).marginals(page), html.Page(layout).labels()
        right = sum((marginals[node] > 0.5) == bool(labels[node]) for node, _ in page.blocks)
        assert right >= 0.8 * len(page.blocks), i


def test_messages_are_exact():
    """Marginals against the sum over all labellings of a small page."""
    import itertools
    import math

    counts = collections.Counter()
    for layout in html.LAYOUTS:
        counts.update(html.Page(layout).counts())
    model = html.Model(counts)
    page = html.Page("<body><div class=ad><p>Buy this.</p></div><div><p>Some text of a length.</p><ul><li>x</li></ul></div></body>")
    n = len(page.tags)
    weight, total = [0.0] * n, 0.0
    for rest in itertools.product((0, 1), repeat=n - 1):
        labels = (0, *rest)
        log = sum(model.seen.get(f, (0.0, 0.0))[labels[i]] for i, fs in enumerate(page.features()) for f in fs)
        for i in range(1, n):
            step = model.edges.get(page.kind(i), model.edges["*"])
            log += step[labels[page.parents[i]]][labels[i]]
        total += math.exp(log)
        for i in range(n):
            weight[i] += labels[i] * math.exp(log)
    assert np.allclose(model.marginals(page), np.array(weight) / total)


def test_licences(docs, spark):
    found = {r["doc_id"]: r for r in licences.scan(docs).collect()}
    assert found[17]["licence"] == "mit-line" and found[17]["dice"] == 1.0
    assert found[1]["licence"] is None and found[1]["n_units"] == 0
    text = licences.TEMPLATES["mit"].replace("sublicense", "relicense").replace(". ", ".\n")
    one = licences.scan(spark.createDataFrame([(1, "x\n\n" + text)], "doc_id long, text string")).first()
    assert one["licence"] == "mit" and 0.95 < one["dice"] < 1


MIT_LAYOUT = """MIT License

Copyright (c) 2020 Some Author

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE.
"""

APACHE_LAYOUT = """   Licensed under the Apache License, Version 2.0 (the "License");
   you may not use this file except in compliance with the License.
   You may obtain a copy of the License at

       http://www.apache.org/licenses/LICENSE-2.0

   Unless required by applicable law or agreed to in writing, software
   distributed under the License is distributed on an "AS IS" BASIS,
   WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
   See the License for the specific language governing permissions and
   limitations under the License.
"""


def _wrapped(text, width):
    """The template's words on lines of ``width`` words, a blank line after every third."""
    words = text.split()
    lines = [" ".join(words[i : i + width]) for i in range(0, len(words), width)]
    return "\n".join(line + "\n" * (i % 3 == 2) for i, line in enumerate(lines))


def test_licences_over_blocks_and_in_paragraphs(spark):
    prose = "The rivers of the north run cold in spring. Nobody counted the boats that year! "
    cases = {
        "mit": MIT_LAYOUT,
        "apache-2.0-notice": f"{prose}\n\n{APACHE_LAYOUT}\n{prose}",
        "gpl-3.0-line": prose + licences.TEMPLATES["gpl-3.0-line"] + " " + prose,
        "cc-by-4.0-line": prose + "\nThis work is licensed under a Creative Commons\nAttribution 4.0 International License.\n" + prose,
    }
    data = [(i, text) for i, text in enumerate(cases.values())]
    names = list(licences.TEMPLATES)
    data += [(100 + i, f"{prose}\n\n{_wrapped(licences.TEMPLATES[n], 5)}\n\n{prose}") for i, n in enumerate(names)]
    data += [(200, prose * 30), (201, MIT_LAYOUT + "\n" + prose * 20 + "\n" + APACHE_LAYOUT), (202, (prose + "\n") * 30 + "software license")]
    data += [(203, MIT_LAYOUT.replace("\n", "\r\n"))]
    found = {r["doc_id"]: r for r in licences.scan(spark.createDataFrame(data, "doc_id long, text string")).collect()}
    for i, name in enumerate(cases):
        assert (found[i]["licence"], found[i]["dice"]) == (name, 1.0)
    for i, name in enumerate(names):
        assert (found[100 + i]["licence"], found[100 + i]["dice"]) == (name, 1.0)
    assert found[0]["n_units"] == 1 and found[201]["n_units"] >= 2 and found[203]["licence"] == "mit"
    assert found[200]["n_units"] == found[202]["n_units"] == 0


def test_licences_equal_sql_over_runs(spark):
    """Licences over lines, cut, mixed and edited at random, against all runs in SQL."""
    prose, names = "The rivers of the north run cold in spring. Nobody counted the boats! ", list(licences.TEMPLATES)
    data = [(i, f"{prose}\n\n{_wrapped(licences.TEMPLATES[n], 5)}\n\n{prose}") for i, n in enumerate(names)]
    data += [(90, MIT_LAYOUT), (91, MIT_LAYOUT + "\n" + prose * 20 + "\n" + APACHE_LAYOUT), (92, None), (93, ""), (94, "Licensed under CC\nBY-NC 4.0 " * 12)]
    data += [(95, "x_license_y \u00c9license\nReleased under the_MIT License."), (96, (prose + "\n") * 300 + "the license\n" + MIT_LAYOUT)]
    rng = random.Random(4)
    for i in range(40):
        words = []
        for name in rng.sample(names, 2):
            words += prose.split()[: rng.randrange(15)] + [w for w in licences.TEMPLATES[name].split() if rng.random() > 0.07]
        data.append((100 + i, "".join(w + rng.choice([" "] * 6 + ["\n", "\n\n", ". "]) for w in words)))
    found = sorted(tuple(r) for r in licences.scan(spark.createDataFrame(data, "doc_id long, text string")).collect())
    db = duckdb.connect()
    db.register("documents", pa.table({"doc_id": [i for i, _ in data], "text": pa.array([t for _, t in data], pa.string())}))
    assert found == sorted(db.execute(licences.scan_sql()).fetchall())
    assert sum(r[2] is not None for r in found) > 40 and sum(r[1] > 1 for r in found) > 10


def test_licences_in_very_many_lines(spark):
    """Time grows with a document's lines, not with their square: 20 000 of them are a matter of seconds."""
    lines = [f"line {i} software license of {i}" for i in range(20_000)]
    data = [(1, "\n".join(lines)), (2, "boats in spring\n" * 20_000 + MIT_LAYOUT), (3, "Licensed under CC\nBY-NC 4.0 " * 10_000)]
    frame = spark.createDataFrame(data, "doc_id long, text string")
    start = time.monotonic()
    found = {r.doc_id: r.licence for r in licences.scan(frame).collect()}
    assert found == {1: None, 2: "mit", 3: "cc-by-nc-4.0-line"} and time.monotonic() - start < 60


def test_licence_gate_loses_no_match():
    for text in licences.TEMPLATES.values():
        own = licences.template_bigrams(text)
        words = licences.gate_words(own)
        # What is left without these words, as a unit of its own, stays below the threshold.
        left = [p for p in own if not words & set(p.split()[:2])]
        assert words and 2 * len(left) < licences.THRESHOLD * (len(left) + len(own))


@pytest.mark.parametrize(
    "run",
    [
        bpe.digests,
        quality.verdicts,
        quality.keep_good,
        sharding.shards,
        suffix.digests,
        suffix.remove_repeats,
        simhash.near_duplicates,
        simhash.deduplicate,
        packing.pack,
        exact.groups,
        exact.deduplicate,
        prefix_counts.token_counts,
        licences.scan,
    ],
)
def test_empty_table(no_docs, run):
    assert run(no_docs).collect() == []


def test_coordinates_of_many_documents_at_once():
    table = packing.directions(50)
    docs = [np.array(ids, "<u4") for ids in ([], [7], [1, 2, 3, 2, 49], list(range(50)) * 9)]
    cells = 1 << packing.DIMENSION_BITS
    for ids, found in zip(docs, packing.coordinates(docs, table).tolist(), strict=True):
        mean = table[ids].mean(axis=0, dtype=np.float64) if len(ids) else np.zeros(packing.DIMENSIONS)
        assert found == np.clip((mean / packing.REACH + 1) / 2 * cells, 0, cells - 1).astype(np.int64).tolist()
    assert packing.coordinates([], table).shape == (0, packing.DIMENSIONS)


def test_only_missing_words_are_encoded():
    asked = []

    class Known:
        def encode_words(self, words):
            asked.append(sorted(words))
            return words

    cache = bpe.WordCache(Known(), bytes.upper)
    cache.fill([[b"a", b"b", b"a"], [b"c"]])
    cache.fill([[b"c", b"d"], []])
    assert asked == [[b"a", b"b", b"c"], [b"d"]] and cache.table[b"d"] == b"D"
