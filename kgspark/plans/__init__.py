"""Registered queries over the driver tables."""

import importlib

MODULES = ["q_patterns", "q_metrics", "q_questions", "q_quality", "q_graph", "q_templates", "q_harvest"]


def load_all() -> None:
    for m in MODULES:
        importlib.import_module(f"kgspark.plans.{m}")
