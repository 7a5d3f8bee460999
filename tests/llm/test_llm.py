"""Each operator of the subpackage on small tables, against brute force where SQL cannot say it."""

import hashlib
import re
import zlib

import duckdb
import numpy as np
import public_tokenizers as public
import pytest
import tiktoken
from tokenizers import Tokenizer

import corpus_pipeline
from quayside.llm import byte_bpe, chat, digest_index, languages, main_text, nn_descent, packing, queries, secrets, setsketch, token_store
from quayside.llm.components import connected_components
from quayside.plans.settle import scratch_path

WORDS = "the of and to in is that for it as was with be by on not he his but at are this have from or had an they which one you".split()


def text_of(seed, n):
    return " ".join(np.random.default_rng(seed).choice(WORDS, n))


BASE = text_of(1, 200)
NEAR = BASE.replace(BASE.split()[100], "changed", 1)
LONG = text_of(2, 60000)
ODD = ["a <|endoftext|><|endoftext|> b<|endoftext|", "<|endoftext|>", "a  b", "\n\nx \n y", "don't 'stop'  ", "é²³ x", "日本 text <|endoftext|>", " ", "tab\tends\x85", "I'll we've"]
ROWS = [(1, BASE), (2, BASE), (3, NEAR), (4, BASE.upper()), (5, None), (6, ""), (7, " \t\n"), (8, "two words"), (9, "two  words"), (10, LONG), (10, LONG), (None, "no id"), (12, "?? 12 !!")]
ROWS += [(20 + i, t) for i, t in enumerate(ODD)]


@pytest.fixture(scope="module")
def docs(spark):
    """Extra columns have names that operators use inside."""
    rows = [(i, t, None if i == 5 else "en", "s", 1, 7, "x", 2) for i, t in ROWS]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, node bigint, digest string, key bigint")


def shingles(text):
    w = re.findall("[^\x20\x09-\x0d]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def test_components(spark):
    links = [(i, i + 1) for i in range(100, 140)] + [(7, 3), (3, 7), (5, 5)]
    got = {r[0]: r[1] for r in connected_components(spark.createDataFrame(links, "src bigint, dst bigint")).collect()}
    assert got == {**{i: 100 for i in range(100, 141)}, 3: 3, 7: 3}
    assert connected_components(spark.createDataFrame([], "src bigint, dst bigint")).count() == 0


def test_near_duplicates_against_brute_force(docs):
    got = sorted((r["doc_id"] or -1, r["n_shingles"], r["component_id"], r["kept"]) for r in setsketch.near_duplicates(docs).collect())
    sets = [(i, shingles(t)) for i, t in ROWS]
    parent = list(range(len(sets)))
    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and y and 100 * len(x & y) >= 75 * len(x | y):
                old, new = parent[a], parent[b]
                parent = [new if p == old else p for p in parent]
    want = []
    for k, (i, s) in enumerate(sets):
        ids = [sets[j][0] for j in range(len(sets)) if parent[j] == parent[k] and sets[j][0] is not None]
        want.append((i or -1, len(s), min(ids, default=None), i == min(ids, default=None)))
    assert got == sorted(want)


def test_near_duplicates_of_nothing(docs):
    assert setsketch.near_duplicates(docs.where("false")).collect() == []


def test_residual_links_against_brute_force(spark):
    sets = {i: sorted(set(np.random.default_rng(i % 3).choice(4000, 60).tolist()) | {i, 2 * i}) for i in range(30)}
    left = spark.createDataFrame([(k, i, i) for k in (1, 2) for i in sets], "key bigint, node bigint, part bigint")
    shing = spark.createDataFrame(list(sets.items()), "node bigint, shingles array<bigint>")
    got = {tuple(r) for r in setsketch._links_across(left, shing, setsketch.Sketch(block=7)).collect()}
    want = {(a, b) for a in sets for b in sets if a > b and 100 * len({*sets[a]} & {*sets[b]}) >= 75 * len({*sets[a]} | {*sets[b]})}
    assert got == want and want


def test_registers_merge_and_estimate():
    rng = np.random.default_rng(3)
    x, y = rng.integers(0, 2**63, 3000, dtype=np.uint64), rng.integers(0, 2**63, 1000, dtype=np.uint64)
    a, b = np.concatenate((x, y)), x
    sketched = setsketch.registers_of(np.concatenate((a, b, y)), np.array([0, len(a), len(a) + len(b)]))
    assert (sketched[0] == np.maximum(sketched[1], sketched[2])).all()
    near = setsketch.likely_similarity(sketched[:1], sketched[1:2], np.array([4000.0]), np.array([3000.0]))
    assert abs(near[0] - 0.75) < 0.12


def test_unlucky_registers_are_confirmed():
    """Of two equally large sets at the threshold 0.61 of the registers may be equal: the pair still gets its exact look."""
    import pyarrow as pa

    rng = np.random.default_rng(4)
    x, y = (setsketch.registers_of(rng.integers(0, 2**63, 1000, dtype=np.uint64), np.array([0]))[0] for _ in range(2))
    y[:117] = x[:117]
    columns = {"src": [2], "dst": [1], "r_a": [x.tobytes()], "r_b": [y.tobytes()], "n_a": [1000], "n_b": [1000]}
    assert [b.num_rows for b in setsketch._likely(setsketch.DEFAULT)([pa.RecordBatch.from_pydict(columns)])] == [1]


def test_exact_dedup_and_persistent_index(spark, docs):
    path = scratch_path(spark, "index")
    first = {(r["doc_id"], r["keep_id"], r["group_size"], r["kept"]) for r in digest_index.deduplicate(docs, digest_index.DigestIndex(spark, path, 4)).collect()}
    assert {(1, 2, 2, False), (2, 2, 2, True), (5, 6, 2, False), (6, 6, 2, True), (10, 10, 2, True), (None, None, 1, True), (8, 8, 1, True)} <= first
    again = digest_index.DigestIndex(spark, path, 4)  # the index of an earlier session
    new = spark.createDataFrame([(100, BASE), (101, "new"), (102, "new")], "doc_id bigint, text string")
    later = sorted((r["doc_id"], r["keep_id"], r["group_size"], r["kept"]) for r in digest_index.deduplicate(new, again).collect())
    assert later == [(100, 2, 3, False), (101, 102, 2, False), (102, 102, 2, True)]
    assert digest_index.deduplicate(docs.where("false"), again).collect() == []
    more = [digest_index.deduplicate(spark.createDataFrame([(200 + i, BASE)], "doc_id bigint, text string"), again).first()["group_size"] for i in range(2)]
    assert more == [4, 5]
    with pytest.raises(ValueError, match="4 buckets, not 3"):
        digest_index.DigestIndex(spark, path, 3)
    before = sorted(map(tuple, again.read().collect()))
    again.compact()
    assert sorted(map(tuple, again.read().collect())) == sorted(map(tuple, digest_index.DigestIndex(spark, path).read().collect())) == before
    assert digest_index.deduplicate(spark.createDataFrame([(300, BASE)], "doc_id bigint, text string"), again).first()["group_size"] == 6
    names = set(t.name for t in spark.catalog.listTables())
    once = digest_index.deduplicate_once(docs)
    assert {(r["doc_id"], r["keep_id"], r["group_size"], r["kept"]) for r in once.collect()} == first
    assert set(t.name for t in spark.catalog.listTables()) == names


def test_packing(spark, docs):
    rows = packing.pack(docs.selectExpr("doc_id", "length(text) AS n_tokens"), budget=1000, buckets=3).collect()
    assert len(rows) == len(ROWS)
    assert len({(r["batch"], r["slot"]) for r in rows}) == len(rows)
    for batch in {r["batch"] for r in rows}:
        own = [r for r in rows if r["batch"] == batch]
        assert len({r["bucket"] for r in own}) == 1 and len(own) <= max(1, 1000 // max(1, own[0]["bucket_length"]))
        assert all(r["padding"] == r["bucket_length"] - r["n_tokens"] >= 0 for r in own)
    assert packing.pack_documents(docs.where("false")).collect() == []


def test_byte_bpe_round_trip(docs):
    ranks = byte_bpe.read_ranks(public.path("byte_bpe_multi_50k.tiktoken"))
    library = tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = sorted((r["doc_id"] or -1, tuple(r["ids"])) for r in byte_bpe.encode(docs, ranks, public.PATTERN, chunk_chars=500, chunk_words=20).collect())
    assert got == sorted((i or -1, tuple(library.encode_ordinary(t or ""))) for i, t in ROWS)
    back = byte_bpe.round_trip(docs, public.path("byte_bpe_multi_50k.tiktoken"), public.PATTERN).collect()
    assert sorted(r["decoded_sha256"] for r in back) == sorted(hashlib.sha256((t or "").encode()).hexdigest() for _, t in ROWS)
    assert byte_bpe.encode(docs.where("false"), ranks, public.PATTERN).collect() == []


def test_token_store(spark, docs):
    json = open(public.path("byte_bpe_50k.json"), encoding="utf-8").read()
    path = scratch_path(spark, "tokens")
    token_store.write_store(docs, path, json, 2, block_ids=300)
    library = Tokenizer.from_file(public.path("byte_bpe_50k.json"))  # untouched
    assert library.encode("a <|endoftext|> b", add_special_tokens=False).ids[2] == 50256
    start, want = 0, []
    for i, t in sorted(ROWS, key=lambda r: (r[0] is not None, r[0])):
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 2]
        want.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(map(tuple, token_store.read_store(spark, path).collect()), key=lambda r: r[1]) == want
    empty = scratch_path(spark, "tokens")
    token_store.write_store(docs.where("false"), empty, json, 2)
    assert token_store.read_store(spark, empty).collect() == []


def test_codes_of_every_width():
    numbers = np.array([0, 255, 256, 65535, 65536, 2**24, 2**32 - 1, 3, 5], np.uint32)
    for n in range(len(numbers) + 1):
        control, data = token_store.pack_codes(numbers[:n])
        assert token_store.unpack_codes(control, data, n).tolist() == numbers[:n].tolist()


def test_main_text(spark):
    page = (
        "<html><head><title>t</title><style>p{}</style></head><body><header>Site</header><nav><a href=/>Home</a></nav><div class='cookie-notice'>We use</div>"
        "<article><h1>A &amp; B</h1><p>First <b>bo</b>ld\n text.<br><div class=ad>Buy</div><p>&lt;last&gt;</article>"
        "<section id=comments><p>nice one</p></section><form>Search</form><footer>c</footer><script>var a='</p>';</script></body>"
    )
    rows = [(1, page), (2, None), (3, ""), (None, "<p>cut of<b"), (5, "<nav>only"), (5, "<p>" + LONG)]
    got = {(r["page_id"], r["text"], r["n_chars"]) for r in main_text.main_texts(spark.createDataFrame([(i, "u", h, 1) for i, h in rows], "page_id int, url string, html string, text int")).collect()}
    assert got == {(1, "A & B\nFirst bold text.\n<last>", 29), (2, "", 0), (3, "", 0), (None, "cut of<b", 8), (5, "", 0), (5, LONG, len(LONG))}


def test_main_text_by_distribution():
    """Article elements are a hint: what stands in a comment, script or other name is none, and text lines decide."""
    menu = "<div><a href=/a>One</a></div>" * 3
    body = f"<p>{BASE}</p><p>{BASE[:300]}</p>"
    want = f"{BASE}\n{' '.join(BASE[:300].split())}"
    for hidden in ("<!-- <article> -->", "<script>var s = '<main>';</script>", "<main-menu></main-menu>"):
        assert main_text.extract(f"{hidden}<div>{body}</div><nav>{menu}</nav>") == want
    teaser = f"<article><p>{BASE[:100]}</p></article>"
    assert main_text.extract(f"<div>{body}</div>{teaser}").startswith(want)
    links = f"<nav>{menu}</nav><p><a href=/b>{BASE[:200]}</a></p>"
    assert main_text.extract(f"<article>{body}{links}</article><div><p>{BASE[:100]}</p></div>") == want


def test_secrets(spark):
    key = "Ab1" * 13 + "c"
    rows = [
        (1, f"é password = 'hunter22' end AKIA{'Z' * 16} {key}"), (2, key), (3, "token: abcd at https://x.example/a"), (4, "token: abcd"), (5, "user = bob; passwd: 12345"),
        (6, None), (6, "f" * 40), (None, "secret=" + "x" * 9), (8, "apikey=short " * 300), (9, "password=abc:token=abcdefgh1"),
    ]
    frame = spark.createDataFrame([(i, t, "c", 5) for i, t in rows], "doc_id bigint, text string, rank string, cell int")
    found = sorted((r["doc_id"] or -1, r["spans"]) for r in secrets.summary(secrets.scan(frame)).collect())
    by = dict(found)
    assert by[1] == f"assign:2:22,access:28:48,key:49:{49 + len(key)}"
    assert by[2] == "" and by[4] == "" and by[3].split(",")[0] == "short:0:11" and "endpoint" in by[3]
    assert by[5] == "ident:0:10,short:12:25" and (6, "hex:0:40") in found and (6, "") in found and by[-1] == "assign:0:16"
    assert by[9] == "assign:13:28" and by[8] == ""
    clean = sorted((r["text"] or "") for r in secrets.redact(frame).collect())
    assert "é [SECRET]' end [SECRET] [SECRET]" in clean and "[SECRET]" in clean and key in clean
    con = duckdb.connect()
    con.register("documents", frame.where("doc_id is not null and doc_id != 6").select("doc_id", "text").toArrow())
    want = con.execute(secrets.oracle()).fetchall()
    got = [tuple(r) for r in secrets.summary(secrets.scan(frame.where("doc_id is not null and doc_id != 6"))).collect()]
    assert sorted(map(repr, want)) == sorted(map(repr, got))


def test_chat(spark):
    rows = [(1, 0, "system", "s"), (1, 1, "user", "</s>[INST] ~1 ok [/INST]"), (1, 2, "assistant", "a<b>~"), (2, 0, "assistant", None), (2, 1, "tool\n<x", "t\nu"), (3, 0, "user", "q"), (None, 0, None, "n"), (4, 5, "user", "b"), (4, 5, "user", "a"), (4, 6, "assistant", "")]
    frame = spark.createDataFrame([(*r, "x") for r in rows], "conv_id bigint, turn int, role string, text string, turns string")
    made = chat.format_conversations(frame)
    assert {(r["conv_id"], r["valid"], r["bad_turn"]) for r in made.collect()} == {(1, True, None), (2, False, 0), (3, False, None), (None, False, 0), (4, False, 1)}
    back = {r["conv_id"]: ([tuple(t) for t in r["turns"]], r["learned"]) for r in chat.read_back(made).collect()}
    assert back[1] == ([("system", "s"), ("user", "</s>[INST] ~1 ok [/INST]"), ("assistant", "a<b>~")], ["a<b>~"])
    assert back[2] == ([("assistant", ""), ("tool\n<x", "t\nu")], [""]) and back[None] == ([("", "n")], [])
    assert back[4][0] == [("user", "a"), ("user", "b"), ("assistant", "")]
    assert chat.digests(chat.read_back(chat.format_conversations(frame.where("false")))).collect() == []


def test_language_model(spark, folder):
    table = spark.read.parquet(f"{folder}/documents.parquet")
    rows = languages.predict(table).join(table.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in rows]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in rows)
    model = languages.train(table.where(~languages.held_out()))
    english, german = (table.where(f"lang = '{x}'").first()["text"][:400] for x in ("en", "de"))
    odd = spark.createDataFrame([(1, None), (2, "12 !?"), (None, english), (4, english + "\n" + german)], "doc_id bigint, text string")
    got = {r["doc_id"]: r for r in languages.identify(odd, model).collect()}
    assert (got[1]["lang_pred"], got[1]["score"], got[2]["lang_pred"]) == ("und", 0.0, "und")
    assert got[None]["lang_pred"] == "en" and {x[:2] for x in got[4]["langs"].split(",")} == {"en", "de"}
    assert languages.predict(table.where("false")).collect() == []


def test_nn_descent_odd_rows(spark):
    v = [1.0, 2.0, 3.0]
    rows = [(1, v, 0), (2, v, 0), (2, [2.0, 4.0, 6.001], 0), (4, v, 1), (5, v, None), (6, None, 0), (7, [0.0] * 3, 0), (8, [1.0, None, 2.0], 0), (9, [float("nan"), 1.0, 1.0], 0), (10, [float("inf"), 1.0, 1.0], 0), (11, [], 0), (12, [1.0, 2.0], 0), (None, v, 0)]
    frame = spark.createDataFrame([(*r, 1) for r in rows], "vec_id bigint, embedding array<float>, label int, node int")
    got = sorted((r["vec_id"] or -1, r["n_links"], r["component_id"], r["kept"]) for r in nn_descent.near_duplicates(frame).collect())
    alone = [(i, 0, i, True) for i in (4, 5, 6, 7, 8, 9, 10, 11, 12)]
    assert got == sorted([(1, 3, 1, True), (2, 3, 1, False), (2, 3, 1, False), (-1, 3, 1, False), *alone])
    assert nn_descent.near_duplicates(frame.where("false")).collect() == []


def brute_links(vectors, labels, threshold=0.98):
    """n_links and the component (smallest index) of each vector."""
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    linked = (unit @ unit.T >= threshold) & (labels[:, None] == labels[None, :])
    np.fill_diagonal(linked, False)
    root = np.arange(len(vectors))
    while True:
        low = np.minimum(root, np.where(linked, root[None, :], len(root)).min(1))
        if (low == root).all():
            return linked.sum(1), root
        root = low


def vector_frame(spark, vectors, labels):
    return spark.createDataFrame([(i, v.tolist(), int(k)) for i, (v, k) in enumerate(zip(vectors, labels, strict=True))], "vec_id bigint, embedding array<double>, label int")


def near(rng, base, spread):
    moved = base + spread * rng.standard_normal(base.shape) / np.sqrt(base.shape[-1])
    return moved / np.linalg.norm(moved, axis=-1, keepdims=True)


def test_nn_descent_finishes_small_groups_beside_a_hot_one(spark):
    """A search too weak to find isolated pairs, and a group whose many links hide them: still every count is right."""
    rng = np.random.default_rng(5)
    bases = near(rng, np.zeros((201, 64)), 1.0)
    vectors = np.concatenate((near(rng, np.repeat(bases[:1], 300, 0), 0.05), bases[1:], near(rng, bases[1:], 0.19)))
    labels = np.zeros(len(vectors), int)
    counts, roots = brute_links(vectors, labels)
    weak = nn_descent.Search(orders=1, window=2, rounds=0, trials=1, widest=200)
    got = sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in nn_descent.near_duplicates(vector_frame(spark, vectors, labels), search=weak).collect())
    assert got == [(i, int(n), int(c)) for i, (n, c) in enumerate(zip(counts, roots, strict=True))] and (counts[300:] > 0).sum() > 300


def test_nn_descent_merges_tight_families(spark):
    """Families larger than a list whose members are all nearer to each other than to the linked other family."""
    rng = np.random.default_rng(11)
    vectors = []
    for _ in range(10):
        one, way = near(rng, np.zeros((2, 64)), 1.0)
        way = (way - way @ one * one) / np.linalg.norm(way - way @ one * one)
        vectors += [near(rng, np.repeat(v[None], 60, 0), 0.002) for v in (one, 0.985 * one + np.sqrt(1 - 0.985**2) * way)]
    vectors = np.concatenate(vectors)
    counts, roots = brute_links(vectors, np.zeros(len(vectors), int))
    unaudited = nn_descent.Search(trials=1, recall=0.0)
    got = sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in nn_descent.near_duplicates(vector_frame(spark, vectors, np.zeros(len(vectors))), search=unaudited).collect())
    assert got == [(i, int(n), int(c)) for i, (n, c) in enumerate(zip(counts, roots, strict=True))] and len(set(roots)) == 10


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_queries_equal_sql(spark, folder, duck, name):
    expected = duck.execute(queries.ORACLES[name])
    columns = [d[0] for d in expected.description]
    got = queries.QUERIES[name](spark, folder)
    assert sorted(got.columns) == sorted(columns)
    assert sorted(map(repr, (tuple(r) for r in got.select(columns).collect()))) == sorted(map(repr, expected.fetchall()))


def test_pipeline_against_brute_force(spark, folder):
    rows = spark.read.parquet(f"{folder}/documents.parquet").orderBy("doc_id").collect()
    last = {r["text"]: r["doc_id"] for r in rows}
    kept = [(r["doc_id"], shingles(r["text"])) for r in rows if last[r["text"]] == r["doc_id"] and any(c.isalpha() for c in r["text"])]
    parent = {i: i for i, _ in kept}
    for k, (i, x) in enumerate(kept):
        for j, y in kept[:k]:
            if x and y and min(len(x), len(y)) * 100 >= 75 * max(len(x), len(y)) and 100 * len(x & y) >= 75 * len(x | y):
                old, new = max(parent[i], parent[j]), min(parent[i], parent[j])
                parent = {n: new if p == old else p for n, p in parent.items()}
    got = corpus_pipeline.run(spark, folder).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(i for i in parent if parent[i] == i)


def odd_stage_input(spark):
    rows = [(i, t, None if i == 5 else "en", None if i == 6 else "s", None if i == 7 else 1) for i, t in ROWS]
    rows += [(40, "no label here at all", None, "s", 1), (41, BASE + " end", "en", None, None), (None, BASE.lower() + " x", None, None, None)]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    clashing = {"_lang": "a", "_kept": "b", "kept": "c", "node": "d", "digest": "e", "component_id": "f", "keep_id": "g", "spans": "h"}
    return spark.createDataFrame(rows, schema), clashing


def test_pipeline_stages_on_odd_rows(spark, folder):
    """Rows without id, label or text, repeated rows and clashing columns: each stage's rows are known."""
    from pyspark.sql import functions as F

    plain, clashing = odd_stage_input(spark)
    wide = plain.withColumns({n: F.lit(v) for n, v in clashing.items()})
    stages = dict(corpus_pipeline.STAGES)
    key = lambda rows: sorted(((r["doc_id"] is not None, r["doc_id"] or 0, r["text"] or "") for r in rows))

    told = stages["language id"](spark, wide, folder)
    assert told.columns == wide.columns
    assert key(told.collect()) == key(r for r in plain.collect() if any(c.isalpha() for c in r["text"] or ""))

    exact = stages["exact dedup"](spark, wide, folder)
    assert exact.columns == wide.columns
    gone = {1, 5}  # of equal texts the largest id stays; rows that repeat id and text both stay
    assert key(exact.collect()) == key(r for r in plain.collect() if r["doc_id"] not in gone)

    near = stages["near dedup"](spark, wide, folder)
    assert near.columns == wide.columns
    found = key(near.collect())
    # The base and its near copies are one group, 8 and 9 have the same words; of the rows without id one is kept, so both stay.
    assert found == key(r for r in plain.collect() if r["doc_id"] not in {2, 3, 4, 41, 9})

    cleaned = stages["secret scan"](spark, wide, folder)
    assert cleaned.columns == wide.columns and cleaned.count() == wide.count()
    assert stages["packing"](spark, wide, folder).count() == wide.count()

    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, wide.where("false"), folder).collect() == [], name
