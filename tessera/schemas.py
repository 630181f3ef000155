"""Declared schemas; nothing is inferred (a version such as 1.10 must stay text)."""

from __future__ import annotations

PULL_REQUEST = (
    "number long, title string, body string, merged_at string, created_at string, updated_at string, "
    "user struct<login:string>, labels array<struct<name:string>>, head struct<sha:string>, "
    "base struct<sha:string,ref:string,repo:struct<full_name:string>>, commits int, additions int, deletions int, "
    "changed_files int, diff_url string, html_url string, commits_url string, resolved_issues array<string>"
)
TASK_INSTANCE = (
    "repo string, instance_id string, pull_number long, issue_numbers array<string>, base_commit string, patch string, "
    "test_patch string, patch_fetch_failed boolean, problem_statement string, hints_text string, created_at string, "
    "version string, language string, FAIL_TO_PASS string, PASS_TO_PASS string, environment_setup_commit string, "
    "workload string, speedup double, covering_tests array<string>, notes string, single_thread_tests array<string>, "
    "python_version string, install_cmd string, test_cmd_override string, packages_source string, "
    "pip_packages array<string>, pre_install_cmds array<string>, reqs_paths array<string>, env_yml_paths array<string>, "
    "log_parser_type string, workload_generation_cost struct<model:string,prompt_tokens:long,completion_tokens:long,"
    "total_tokens:long,cost_usd:double>"
)
PREDICTION = "instance_id string, model_patch string, model_name_or_path string"
TEST_STATUS = "run int, instance_id string, test string, status string, pos long"
REPORT = (
    "instance_id string, raw_pred_speedup_ratio double, pred_speedup_ratio double, gold_speedup_ratio double, "
    "human_speedup_ratio double, correctness double, correctness_pct double, pre_edit_runtime double, patch_length int, "
    "has_pred_perf boolean, data_quality string"
)
TRAJECTORY = (
    "instance_id string, attempt int, test_result struct<git_patch:string>, instruction string, error string, "
    "history array<struct<action:string,source:string>>, metrics struct<accumulated_cost:double,"
    "token_usages:array<struct<prompt_tokens:long,completion_tokens:long>>>, metadata struct<model_name:string,"
    "cost:double,timestamp:string>"
)
KV_ROW = "namespace string, key string, value string, fetched_at double"
