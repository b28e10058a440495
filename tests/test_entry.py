"""Driver contract: entry runs, every query has an oracle, names line up."""
import __spark_entry__ as e


def test_entry_smoke(spark):
    df = e.entry(spark)
    assert df.count() > 0
    assert "order_id" in df.columns and "user_key" in df.columns


def test_every_query_has_oracle_sql():
    """All warehouse queries have SQL; of the corpus queries those SQL can express."""
    q, o = e.queries(), e.oracle_sql()
    assert set(o) <= set(q)
    assert all(n in o for n in q if not n.startswith("op") and n != "pipeline")


def test_corpus_queries_are_optional(tmp_path):
    """Without the corpus subpackage and pipeline, or a library that they need, the entry
    still imports; an error inside them is not swallowed."""
    import shutil
    import subprocess
    import sys
    from pathlib import Path

    root = Path(e.__file__).parent
    for d in ("cartwright", "cartwright_catalog"):
        shutil.copytree(root / d, tmp_path / d, ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(root / "__spark_entry__.py", tmp_path)
    run = [sys.executable, "-c", "import __spark_entry__ as e; q = e.queries(); "
           "assert 'fact_orders' in q and not [n for n in q if n.startswith('op')], list(q)"]
    done = subprocess.run(run, cwd=tmp_path, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr
    (tmp_path / "cartwright" / "llm").mkdir()
    (tmp_path / "cartwright" / "llm" / "catalog.py").write_text("import no_such_module\n")
    done = subprocess.run(run, cwd=tmp_path, capture_output=True, text=True)
    assert done.returncode == 0 and "no_such_module" in done.stderr
    for broken in ("import cartwright.nowhere\n", "from cartwright.session import nothing\n", "1 / 0\n"):
        (tmp_path / "cartwright" / "llm" / "catalog.py").write_text(broken)
        assert subprocess.run(run, cwd=tmp_path, capture_output=True, text=True).returncode != 0


def test_product_does_not_import_the_catalog_or_the_corpus_operators():
    import re
    from pathlib import Path

    root = Path(e.__file__).parent / "cartwright"
    for f in root.rglob("*.py"):
        text = f.read_text()
        assert "cartwright_catalog" not in text, f
        if "llm" not in f.parts:
            assert not re.search(r"cartwright\.llm|from \.+llm", text), f


def test_raw_layer_is_whole(spark):
    """The landed raw layer keeps every order of the driver table."""
    from conftest import SF_SMALL

    from cartwright_catalog.landed import landed_raw_layer
    from cartwright_catalog.driver_tables import read_table
    raw = landed_raw_layer(spark, SF_SMALL)
    assert raw.orders.count() == read_table(spark, SF_SMALL, "orders").count()
