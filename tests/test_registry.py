import re
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).parents[1]


def test_registry_names_match():
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
    assert callable(e.entry)


def test_the_rest_stands_without_the_llm_folders(tmp_path):
    """The library and its registry work where the subpackage and the pipeline are gone."""
    code = "import sys; sys.path.insert(0, '.'); import __spark_entry__ as e; q = e.queries(); assert q and not any(k.startswith('op') and k[2].isdigit() for k in q) and 'pipeline' not in q; assert set(e.oracle_sql()) <= set(q)"
    for f in ROOT.rglob("*.py"):
        part = f.relative_to(ROOT)
        if "llm" in part.parts or part.name == "corpus_pipeline.py" or ".git" in part.parts:
            continue
        (tmp_path / part).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / part).write_text(f.read_text())
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env={"PATH": "/usr/bin:/bin:/usr/local/bin"})


def test_nothing_else_imports_the_llm_subpackage():
    for f in (ROOT / "rostrum").rglob("*.py"):
        if "llm" not in f.relative_to(ROOT).parts:
            assert not re.search(r"(import|from)\s.*\bllm\b", f.read_text()), f
