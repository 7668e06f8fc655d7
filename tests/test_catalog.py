"""Each catalogue query with SQL gives what DuckDB gives; the others run and keep their shape."""

import difflib
import re
from collections import defaultdict

import duckdb
import pytest

import __spark_entry__ as entry
from palimpsest.functions import dom
from palimpsest.plans.catalog import ORACLES, QUERIES

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations client_changes".split()


@pytest.fixture(scope="module")
def con(sf):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def shown(rows):
    return sorted(str([round(v, 9) if isinstance(v, float) else v for v in r]) for r in rows)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, sf, name):
    got = QUERIES[name](spark, sf)
    if name not in ORACLES:
        assert got.count() > 0
        return
    found = con.execute(ORACLES[name])
    columns = [c[0] for c in found.description]
    assert sorted(got.columns) == sorted(columns)
    assert shown(got.select(columns).collect()) == shown(found.fetchall())


def test_similarity_of_answers(spark, con, sf):
    """The ratio of each question and its answer, by the standard library over the table's own rows."""
    turns = defaultdict(lambda: defaultdict(list))
    for conv, turn, role, text in con.execute("SELECT conv_id, turn, role, text FROM conversations ORDER BY conv_id, turn").fetchall():
        turns[conv][role].append((turn, text))
    want = {(c, t): difflib.SequenceMatcher(None, a, b).ratio() for c, r in turns.items() if len(r["user"]) == len(r["assistant"]) for (t, a), (_, b) in zip(r["user"], r["assistant"], strict=True)}
    assert {(r.conv_id, r.turn): r.ratio for r in QUERIES["similarity_pairs"](spark, sf).collect()} == want


def test_fidelity_of_pages(spark, con, sf):
    pages = con.execute("SELECT html FROM pages").fetchall()
    article = lambda h: " ".join(re.sub("<[^>]+>", " ", (re.search("(?s)<article>(.*?)</article>", h) or [None, ""])[1]).split())
    ratios = [difflib.SequenceMatcher(None, article(h), dom.visible_text(h)).ratio() for (h,) in pages]
    row = QUERIES["fidelity_scan"](spark, sf).first()
    assert (row.pages, row.compared, row.low) == (len(pages), len(pages), sum(r < 0.9 for r in ratios)) and abs(row.mean_over_all - sum(ratios) / len(ratios)) < 1e-9


def test_chunks_of_pages(spark, con, sf):
    """Innermost blocks by the definition, one node after another."""
    want = {}
    for page, html in con.execute("SELECT page_id, html FROM pages").fetchall():
        blocks = [n for n in dom.clean(html).walk() if n.tag in dom.BLOCKS and not any(d.tag in dom.BLOCKS for c in n.children for d in c.walk()) and not any(a.tag in dom.VERBATIM for a in n.ancestors()) and n.inner().strip()]
        want[page] = (len(blocks), sum(bool(re.search(dom.SOURCE_SCRIPT, n.content(" "))) for n in blocks), sum(len(n.content(" ")) for n in blocks))
    assert {r.page_id: (r.chunks, r.translate, r.chars) for r in QUERIES["chunk_blocks"](spark, sf).collect()} == want


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert entry.oracle_sql().keys() <= entry.queries().keys()


def test_without_the_optional_part(tmp_path):
    """The entry file imports and lists its queries where the optional part is gone."""
    import shutil
    import subprocess
    import sys
    from pathlib import Path

    root = Path(entry.__file__).parent
    shutil.copytree(root / "palimpsest", tmp_path / "palimpsest", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(root / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert q and not any(n.startswith('op') or n == 'pipeline' for n in q); assert e.oracle_sql().keys() <= q.keys()"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, timeout=120)
