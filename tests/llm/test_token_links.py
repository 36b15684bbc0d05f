import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from facetforge.llm import token_links
from facetforge.llm.queries import op12_token_links
from facetforge.llm.token_links import PerfectHash, link_tokens

COLUMNS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups")


@pytest.fixture(scope="module")
def tokenizers():
    a = Tokenizer.from_file(public_tokenizers.path(token_links.BYTE_FILE))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(token_links.PIECE_FILE))
    return a, b


def by_hand(texts, tokenizers):
    """Whole texts by the tokenizers' own libraries, all links listed."""
    a, b = tokenizers
    letters, counts, aligned = token_links._byte_letters(), Counter(), []
    for text in texts:
        if not text:
            aligned.append(None)
            continue
        raw = (" " + text).encode()
        a_ids, b_ids = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        a_bytes = [bytes(letters[c] for c in a.id_to_token(i)) for i in a_ids]
        pieces = [b.id_to_piece(i) for i in b_ids]
        b_bytes = [
            bytes([int(p[3:5], 16)]) if p.startswith("<0x") and len(p) == 6 else p.replace("▁", " ").encode()
            for p in pieces
        ]
        if b"".join(a_bytes) != raw or b"".join(b_bytes) != raw:
            aligned.append(None)
            continue
        a_ends = np.cumsum([len(t) for t in a_bytes]).tolist()
        b_ends = np.cumsum([len(t) for t in b_bytes]).tolist()
        a_after = {end: k for k, end in enumerate(a_ends, 1)}
        b_after = {end: k for k, end in enumerate(b_ends, 1)}
        groups, i, j = [], 0, 0
        for end in sorted(set(a_ends) & set(b_ends)):
            k, m = a_after[end], b_after[end]
            groups.append((a_ids[i:k], b_ids[j:m]))
            i, j = k, m
        links = [(x, y) for left, right in groups for x in left for y in right]
        counts.update(set(links))
        aligned.append((a_ids, b_ids, groups, links))
    best = defaultdict(int)
    for (x, _), n in counts.items():
        best[x] = max(best[x], n)
    for found in aligned:
        if found is None:
            yield (0,) * 6 + ("",)
            continue
        a_ids, b_ids, groups, links = found
        written = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        yield (
            len(a_ids),
            len(b_ids),
            len(groups),
            len(links),
            sum(counts[k] == best[k[0]] for k in links),
            sum(counts[k] for k in links),
            written,
        )


def odd_texts():
    rng = random.Random(3)
    alphabet = "ab  \n\t'’éß中1😀.,!s  \x1c\x85▁<>0x4"
    texts = ["  lead", "trail  ", "<|endoftext|> <s> </s> <unk> <0x41> ▁ a▁b", "é́" * 50, "a\tb　c d", " \xa0x"]
    texts += ["".join(rng.choice(alphabet) for _ in range(300)) for _ in range(40)]
    words = "the river of green stone house and light".split()
    return texts + [" ".join(rng.choices(words, k=40)) + "\nA line." for _ in range(30)]


def test_hard_texts_equal_whole_texts(hard_docs, tokenizers):
    rows = link_tokens(hard_docs).collect()
    wanted = by_hand([r["text"] for r in rows], tokenizers)
    for row, other in zip(rows, wanted, strict=True):
        assert tuple(row[c] for c in COLUMNS) == other
        assert row["a.key"] == "x"


@pytest.mark.parametrize("block", [1 << 22, 700])
def test_blocks_of_pairs_add_up(spark, make_docs, tokenizers, monkeypatch, block):
    # Parts of few pairs, and blocks of seven parts: several passes.
    monkeypatch.setattr(token_links, "PART_PAIRS", 100)
    monkeypatch.setattr(token_links, "SLICE_ROWS", 7)
    monkeypatch.setattr(token_links, "HELD_CHUNKS", 50)
    monkeypatch.setattr(token_links, "HELD_PAIRS", 60)
    texts = odd_texts()
    rows = link_tokens(make_docs(texts).repartition(4), block_pairs=block).orderBy("doc_id").collect()
    assert [tuple(r[c] for c in COLUMNS) for r in rows] == list(by_hand(texts, tokenizers))


def test_query(spark, tmp_path, tokenizers):
    texts = [*odd_texts(), None, "", "repeat me", "repeat me"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(
        f"{tmp_path}/documents.parquet"
    )
    rows = op12_token_links(spark, str(tmp_path)).orderBy("doc_id").collect()
    for row, other in zip(rows, by_hand(texts, tokenizers), strict=True):
        digest = hashlib.sha256(other[-1].encode()).hexdigest() if other[0] else ""
        assert tuple(row)[1:] == (*other[:-1], digest)


def test_empty_table_and_clashing_names(spark, no_docs):
    assert link_tokens(no_docs).count() == 0
    docs = spark.createDataFrame([("a b", 7)], "text string, N_A int")
    result = link_tokens(docs)
    assert result.columns == ["text", *COLUMNS] and result.first()["n_a"] == 2


def test_perfect_hash_is_minimal():
    rng = np.random.default_rng(1)
    for n in (0, 1, 63, 64, 5000):
        keys = rng.choice(1 << 40, n, replace=False).astype(np.uint64)
        hashed = PerfectHash.of(keys)
        assert sorted(hashed.places(keys).tolist()) == list(range(n))
        assert 64 * len(hashed.words) <= 5 * n + 640
