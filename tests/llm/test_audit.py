"""The divergence audit against its SQL in DuckDB, and the transducer against a sorted list."""

import random
import re

import duckdb
import pyarrow as pa
import pyarrow.parquet as pq

from llm.helpers import EDGES, syllables
from postloom.llm import audit


def test_transducer_gives_lexicographic_ordinals():
    rng = random.Random(3)
    words = sorted({"".join(rng.choice("abcé漢") for _ in range(rng.randint(1, 7))).encode() for _ in range(3000)})
    fst = audit.Vocabulary(words)
    assert fst.size == len(words) and all(fst.ordinal(w) == i for i, w in enumerate(words))
    assert fst.ordinal(b"zz") is None and fst.ordinal(words[0][:0]) is None
    assert fst.states < sum(map(len, words))  # suffixes are shared
    assert audit.Vocabulary([]).size == 0


def run_sql(rows, tmp_path):
    path = str(tmp_path / "d.parquet")
    cols = list(zip(*rows)) if rows else [[], [], [], []]
    pq.write_table(pa.table({"doc_id": pa.array(cols[0], pa.int64()), "text": pa.array(cols[1], pa.string()),
                             "lang": pa.array(cols[2], pa.string()), "source": pa.array(cols[3], pa.string())}), path)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{path}')")
    return con.execute(audit.oracle_sql()).fetchall()


def test_audit_equals_its_sql(spark, tmp_path):
    rng = random.Random(8)
    rows = []
    for i in range(300):
        lang = rng.choice(["en", "de", None, "xx"])
        source = rng.choice(["a", "b", "c", None, "hot", "hot", "hot"])
        rows.append((i, syllables(rng, rng.randint(0, 60)) + rng.choice([" Foo BAR", " foo_bar9", ""]), lang, source))
    rows += [(1000 + i, t, "en", "edge") for i, t in enumerate(EDGES)] + [rows[4]] * 5
    rows += [(2000, "only one source here alpha alpha", "solo", "s"), (2001, "beta", "empty", "x"), (2002, None, "empty", "y")]
    df = spark.createDataFrame([(*r, 1, "clash") for r in rows], "doc_id bigint, text string, lang string, source string, count int, term string")
    got = sorted(map(tuple, audit.audit(df).collect()))
    want = sorted(run_sql(rows, tmp_path))
    assert got == want
    assert {r[0] for r in got if r[2] == "pair"} >= {"empty"} and not any(r[0] == "solo" for r in got if r[2] == "pair")
    assert audit.audit(df.limit(0)).count() == 0


def test_counts_of_a_task(monkeypatch):
    """Against plain loops, over batches of several sizes; slices of batches too."""
    rng = random.Random(4)
    texts = [t or "" for t in EDGES] + ["".join(rng.choice(["a", "B", "Éé", "漢", " ", "\n", "_9", "\x7f", "\x80", "K"]) for _ in range(rng.randint(0, 30))) for _ in range(400)]
    rows = [(rng.choice(["", "en", "de"]), rng.choice(["", "x", "y"]), t) for t in texts]
    want = {}
    for lang, source, text in rows:
        terms = re.findall(audit.TERM, text.translate(str.maketrans(audit.UPPER, audit.LOWER)))
        for term in set(terms):
            n, docs = want.get((lang, source, term), (0, 0))
            want[lang, source, term] = n + terms.count(term), docs + 1
    whole = pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*rows)], names=["lang", "source", "text"])
    cuts = [0, 0, 1, 7, 60, 61, 300, len(rows)]
    for size in (1, 2000, 1 << 20):
        monkeypatch.setattr(audit, "COUNTED_BYTES", size)
        made = list(audit.term_counts(iter(whole.slice(a, b - a) for a, b in zip(cuts, cuts[1:]))))
        assert len(made) == {1: 6, 1 << 20: 1}.get(size, len(made))
        got = {}
        for batch in made:
            for *key, n, docs in zip(*(c.to_pylist() for c in batch.columns)):
                had = got.get(tuple(key), (0, 0))
                got[tuple(key)] = had[0] + n, had[1] + docs
        assert got == want


def test_each_term_goes_through_the_transducer_once(monkeypatch):
    asked, ordinal = [], audit.Vocabulary.ordinal
    monkeypatch.setattr(audit.Vocabulary, "ordinal", lambda self, w: asked.append(w) or ordinal(self, w))
    monkeypatch.setattr(audit.TaskContext, "get", lambda: type("Task", (), {"partitionId": lambda self: 3})())
    rows = [("de", "b", 0, None, 0), ("de", "b", 1, "x", 2), ("de", "b", 1, "y", 5), ("de", "c", 1, "x", 9), ("en", "a", 1, "x", 1), ("en", "é", 0, None, 0), ("en", "é", 1, "x", 4)]
    types = [pa.string(), pa.string(), pa.int32(), pa.string(), pa.int64()]
    whole = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=["lang", "term", "kind", "source", "count"])
    made = [r for b in audit.recount(iter([whole.slice(0, 2), whole.slice(2)])) for r in zip(*(c.to_pylist() for c in b.columns))]
    assert made == [(3, "de", None, None, None, 1), (3, "de", "x", 0, "b", 2), (3, "de", "y", 0, "b", 5), (3, "en", None, None, None, 1), (3, "en", "x", 0, "é", 4)]
    assert asked == [b"b", b"c", b"a", "é".encode()]
    assert list(audit.recount(iter([]))) == []
