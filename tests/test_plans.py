"""Plan shapes that have to hold at scale."""

import pytest

import __spark_entry__ as contract

# Queries that only plan; the others run jobs while they are built.
LAZY = [
    "keyword_accuracy_by_difficulty", "eval_full_report", "semantic_similarity", "perplexity_by_group", "clean_pages",
    "page_records", "chunk_documents", "truncate_tokens", "build_conversations", "useful_conversations", "content_top50",
    "train_eval_split", "turns_with_split", "split_filter_counts", "stratified_sample", "stratified_sample_open",
    "first_k_sample", "merge_datasets", "classification_report", "confusion_matrix", "score_reasoning", "class_counts",
]


def plan_of(spark, sf_dir, name):
    return contract.queries()[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_no_cartesian_product(spark, sf_dir, name):
    plan = plan_of(spark, sf_dir, name)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


@pytest.mark.parametrize("name", ["clean_pages", "chunk_documents", "truncate_tokens", "page_records", "title_extract"])
def test_row_operators_do_not_shuffle(spark, sf_dir, name):
    assert "Exchange" not in plan_of(spark, sf_dir, name)


@pytest.mark.parametrize("name", ["keyword_accuracy_by_difficulty", "tag_integrity", "split_filter_counts"])
def test_reports_aggregate_before_the_shuffle(spark, sf_dir, name):
    assert "partial_count" in plan_of(spark, sf_dir, name)


def test_texts_stay_out_of_the_count_shuffle(spark, sf_dir):
    plan = plan_of(spark, sf_dir, "content_top50")
    counts = next(line for line in plan.splitlines() if "partial_count" in line)
    assert "keys=[digest" in counts and "content" not in counts.split("output")[-1].split("digest", 1)[0]


def test_scans_read_only_the_columns_used(spark, sf_dir):
    plan = plan_of(spark, sf_dir, "class_counts")
    assert "ReadSchema: struct<doc_id:bigint>" in plan
    plan = plan_of(spark, sf_dir, "chunk_documents")
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in plan


def test_member_filter_reaches_the_scan(spark, sf_dir):
    plan = plan_of(spark, sf_dir, "keyword_accuracy_by_difficulty")
    assert "EqualTo(role,user)" in plan and "EqualTo(role,assistant)" in plan


def test_chunks_are_computed_once(spark, sf_dir):
    assert plan_of(spark, sf_dir, "chunk_documents").count("regexp_extract_all") == 1


def test_one_hook_embeds_both_answers(spark, sf_dir):
    assert plan_of(spark, sf_dir, "embed_and_compare").count("MapInArrow") == 1


def test_skipped_rows_do_not_run_the_input_twice(spark, sf_dir):
    plan = plan_of(spark, sf_dir, "score_reasoning")
    assert "Union" not in plan and plan.count("Location:") == 2  # documents and labels, once each


def test_one_look_up_serves_both_cuts(spark, sf_dir):
    df = contract.queries()["turns_with_split"](spark, sf_dir)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("Location:") <= 3


def test_samples_of_open_classes_shuffle_keys_only(spark, sf_dir):
    plan = plan_of(spark, sf_dir, "stratified_sample_open")
    assert "WindowGroupLimit" in plan and "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
