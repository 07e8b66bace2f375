"""Plan shape of registered queries: nothing that stops a job from growing."""

from __future__ import annotations

import re

import pytest

from pairforge.plans.queries import QUERIES

# written and read back inside the query, so building the frame already runs jobs
EAGER = re.compile(r"^(scan_json|scan_jsonl|scan_large|sink_|stream_|list_sessions|pick_split|job_flatten)")
LAZY = sorted(name for name in QUERIES if not EAGER.match(name) and name != "batched_map")


def plan_of(spark, name, sf_dir):
    frame = QUERIES[name](spark, sf_dir)
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_no_global_window_cross_join_or_python(spark, sf_dir, name):
    plan = plan_of(spark, name, sf_dir)
    assert not re.search(r"Python|ArrowEval|CartesianProduct|BroadcastNestedLoopJoin", plan)
    for window in re.findall(r"Window \[.*", plan):
        # ..., [partition keys], [order keys]
        assert re.search(r"\], \[\w", window), window


@pytest.mark.parametrize(
    ("name", "shuffles"),
    [
        ("recipe_records", 1),
        ("extract_links", 1),
        ("token_count", 1),
        ("conversation_to_text", 1),
        ("word_frequency", 1),
        ("sentence_scores", 1),
    ],
)
def test_shuffle_counts(spark, sf_dir, name, shuffles):
    assert plan_of(spark, name, sf_dir).count("Exchange hashpartitioning") <= shuffles


def test_only_needed_columns_are_read(spark, sf_dir):
    plan = plan_of(spark, "questions_with_recipe", sf_dir)
    assert "PushedFilters: [IsNotNull(role), EqualTo(role,user)" in plan
    assert "html" not in plan_of(spark, "pending_pairs", sf_dir)


def test_lists_of_words_are_made_after_the_recipe_join(spark, sf_dir):
    from pairforge.plans.queries import _asked

    plan = _asked(spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_extract_all" in plan.split("Join Inner")[0]
    assert "regexp_extract_all" not in plan.split("Join Inner")[1]
