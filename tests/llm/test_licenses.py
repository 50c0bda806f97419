"""Licence scan: long expressions, base figures by brute force, tasks without the package."""

import pathlib
import random
import re
import subprocess
import sys

from rankloom.llm import licenses, queries

REPO = pathlib.Path(__file__).resolve().parents[2]


def test_long_expressions_are_read_whole():
    assert licenses.evaluate(" and ".join(["mit"] * 130 + ["gpl-3.0"])) == (frozenset({"mit", "gpl"}), 2)
    many = licenses.evaluate(" or ".join(f"x{i}" for i in range(50_000)) + " and mit -->")
    assert len(many[0]) == 50_001
    assert licenses.evaluate("(" * 20_000 + "mit" + ")" * 20_000) == (frozenset({"mit"}), 0)
    assert licenses.evaluate("(" * 20_000 + "mit") is None


def test_longest_beginning_is_the_one_that_parses():
    rng = random.Random(1)
    for _ in range(3000):
        parts = [rng.choice(["mit", "gpl", "(", ")", "and", "or", "with"]) for _ in range(rng.randrange(9))]
        wanted = max((n for n in range(1, len(parts) + 1) if licenses.postfix(parts[:n])), default=0)
        assert licenses.longest(parts) == wanted, parts


def test_base_figures_are_brute_force(spark, sf_dir):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = queries.op9_license_scan(spark, sf_dir).collect()
    assert {r["doc_id"] for r in rows} == set(texts)
    for r in rows:
        low = re.sub("[A-Z]", lambda m: m[0].lower(), texts[r["doc_id"]] or "")
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
        places = [(i, label) for phrase, label in licenses.BASE.items() for i in range(len(words)) if words[i : i + len(phrase.split())] == phrase.split()]
        starts = [i for i, _ in places] or [None]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"]) == (len(words), len(places), min(starts), max(starts))
        assert r["base_labels"] == ",".join(sorted({label for _, label in places}))


def test_tasks_need_no_installed_package(sf_dir, tmp_path):
    """Started from another folder, workers find the package nowhere; its code must come with the tasks."""
    code = f"""
import sys
sys.path.insert(0, {str(REPO)!r})
from rankloom.session import local_session
from rankloom.llm import queries
spark = local_session(4, partitions=2, memory="2g")
for name in ("op9_license_scan", "op11_interpolated_model", "op13_structure_repair", "op2_toxic_segments"):
    print(name, len(queries.QUERIES[name](spark, {sf_dir!r}).collect()))
"""
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=600, env={k: v for k, v in __import__("os").environ.items() if k != "PYTHONPATH"})
    assert done.returncode == 0, done.stderr[-2000:]
    assert len(done.stdout.split()) == 8
