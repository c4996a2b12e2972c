import re
from collections import defaultdict

import xxhash
from helpers import edge_docs, edge_rows, no_docs, prose

from herald.llm import simhash_near_dedup as S


def brute_fingerprint(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(fps, radius=3):
    parent = {f: f for f in fps}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in fps:
        for b in fps:
            if a < b and (a ^ b).bit_count() <= radius:
                parent[find(a)] = find(b)
    return {f: find(f) for f in fps}


def expected(rows):
    fps = [brute_fingerprint(r[1]) for r in rows]
    roots, least = brute_components(set(fps)), defaultdict(list)
    for r, f in zip(rows, fps):
        if r[0] is not None:
            least[roots[f]].append(r[0])
    return sorted(((r[0], f, min(least[roots[f]], default=None)) for r, f in zip(rows, fps)), key=repr)


def found(df):
    return sorted(((r.doc_id, r.fp % 2 ** 64, r.component_id) for r in df.collect()), key=repr)


def test_awkward_rows_match_brute_force(spark):
    assert found(S.near_duplicates(edge_docs(spark))) == expected(edge_rows())


def test_tiling_changes_nothing(spark):
    rows = []
    for i in range(220):
        words = prose(150, i % 60).split()
        words[(7 * i) % 150] = f"w{i}"
        rows.append((i, " ".join(words), "en", "a", 0))
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    want = expected([r[:2] for r in rows])
    assert len({c for _, _, c in want}) < len(rows)
    for two_parts in (False, True):
        assert found(S.near_duplicates(df, tile_rows=4, two_parts=two_parts)) == want


def test_chain_of_links_is_one_component(spark):
    fps = [0]
    for i in range(20):
        fps.append(fps[-1] ^ (0b111 << 3 * i))
    from herald.llm.components import component_labels
    classes = spark.createDataFrame([(f if f < 2 ** 63 else f - 2 ** 64,) for f in fps], "fp long")
    labels = component_labels(S.near_links(classes, 3, tile_rows=2)).collect()
    assert len(labels) == len(fps) and len({r.label for r in labels}) == 1


def test_one_of_each_keeps_smallest_id_once(spark):
    kept = S.one_of_each(edge_docs(spark, clashing=False))
    ids = sorted((r.doc_id for r in kept.collect()), key=repr)
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert ids.count(12) == 1 and 2 not in ids and 1 in ids
    assert 4 in ids and 5 not in ids and 6 not in ids  # empty texts are one group


def test_empty_table(spark):
    assert S.near_duplicates(no_docs(spark)).count() == 0
    assert S.one_of_each(no_docs(spark)).count() == 0


def test_long_text_in_parts(monkeypatch):
    text = prose(3000, 5).encode()
    whole = S.simhash(text)
    monkeypatch.setattr(S, "HASHES_AT_ONCE", 97)
    assert S.simhash(text) == whole == brute_fingerprint(text.decode())
