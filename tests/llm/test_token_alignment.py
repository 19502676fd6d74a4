"""op11: alignment of two tokenizers against the libraries and sets of offsets."""

import collections
import hashlib
import random

import pytest

from chanloom.llm import queries, token_alignment
from chanloom.llm.tokenizer_files import byte_bpe, piece_bpe

tokenizers = pytest.importorskip("tokenizers")
sentencepiece = pytest.importorskip("sentencepiece")
SF = "/root/testdata/sf0.001"


class Libraries:
    def __init__(self):
        self.a = tokenizers.Tokenizer.from_file(byte_bpe())
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=piece_bpe())
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in shown]
        self.byte = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}

    def a_bytes(self, i):
        return bytes(self.byte[c] for c in self.a.id_to_token(i))

    def b_bytes(self, i):
        name = self.b.id_to_piece(i)
        return bytes([int(name[3:5], 16)]) if self.b.is_byte(i) else name.replace("▁", " ").encode()

    def groups(self, text):
        """Lists of (A ids, B ids), or None without tokens."""
        if not text:
            return None
        a, b = self.a.encode(" " + text, add_special_tokens=False).ids, self.b.encode(text)
        sides = [[self.a_bytes(i) for i in a], [self.b_bytes(i) for i in b]]
        if any(b"".join(s) != (" " + text).encode() for s in sides):
            return None
        ends = []
        for side in sides:
            at, own = 0, []
            for raw in side:
                at += len(raw)
                own.append(at)
            ends.append(own)
        out, i, j = [], 0, 0
        for cut in sorted(set(ends[0]) & set(ends[1])):
            x, y = i, j
            while i < len(a) and ends[0][i] <= cut:
                i += 1
            while j < len(b) and ends[1][j] <= cut:
                j += 1
            out.append((a[x:i], b[y:j]))
        return out


@pytest.fixture(scope="module")
def libraries():
    return Libraries()


def expected(texts, libraries):
    groups = [libraries.groups(t) for t in texts]
    links = [collections.Counter((a, b) for x, y in g or [] for a in x for b in y) for g in groups]
    count = collections.Counter(pair for held in links for pair in held)
    best = collections.defaultdict(int)
    for (a, _), n in count.items():
        best[a] = max(best[a], n)
    rows = []
    for g, held in zip(groups, links):
        if g is None:
            rows.append((0,) * 6 + ("",))
            continue
        shown = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in g)
        rows.append((sum(len(x) for x, _ in g), sum(len(y) for _, y in g), len(g), sum(held.values()), sum(n for p, n in held.items() if count[p] == best[p[0]]),
                     sum(n * count[p] for p, n in held.items()), hashlib.sha256(shown.encode()).hexdigest()))
    return rows


COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def test_query_equals_brute_force(spark, libraries):
    docs = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()
    got = {r.doc_id: tuple(r[c] for c in COLUMNS) for r in queries.QUERIES["op11_token_alignment"](spark, SF).collect()}
    assert got == dict(zip([d.doc_id for d in docs], expected([d.text for d in docs], libraries)))


def test_odd_texts_and_clashing_columns(spark, libraries, monkeypatch):
    # small chunks: pairs of many chunks are summed; large groups by distinct ids
    monkeypatch.setattr(token_alignment, "CHUNK_CHARS", 300)
    monkeypatch.setattr(token_alignment, "BATCH_CHARS", 100)
    monkeypatch.setattr(token_alignment, "GROUP_LINKS", 1)
    random.seed(11)
    parts = ["a", "B", " ", "  ", "\n", "\t", "é", "漢", "😀", "▁", "<|endoftext|>", "<s>", "<0x41>", "12", "　", "ﬁ", "'s", ".", "the", "ing", "\x00", "don't", "\r\n", "한국"]
    texts = ["".join(random.choice(parts) for _ in range(random.randint(0, 12))) for _ in range(300)]
    texts += [None, "", " ", "  ", "same text", "same text", "y" * 9_000, " " * 3_000, "word " * 4_000]
    rows = [(i if i % 50 else None, t, "x", 1, 2, 3, "g") for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, chunk string, pair long, place int, n long, which string")
    out = token_alignment.aligned_documents(df.repartition(3), byte_bpe(), piece_bpe()).collect()
    want = collections.Counter((r[0], *e) for r, e in zip(rows, expected(texts, libraries)))
    assert collections.Counter((r.doc_id, *[r[c] for c in COLUMNS]) for r in out) == want


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert token_alignment.aligned_documents(df, byte_bpe(), piece_bpe()).collect() == []


def test_whole_texts_where_runs_do_not_do(libraries):
    texts = ["two  words", "a b c ", "x\ny"]
    whole = token_alignment.PieceModel(piece_bpe())
    whole.by_run = False
    by_run = token_alignment.token_ids(texts, byte_bpe(), piece_bpe())
    token_alignment.worker_cache().piece_models[piece_bpe()] = whole
    try:
        at_once = token_alignment.token_ids(texts, byte_bpe(), piece_bpe())
    finally:
        del token_alignment.worker_cache().piece_models[piece_bpe()]
    assert [x.tolist() for x in by_run] == [x.tolist() for x in at_once]
