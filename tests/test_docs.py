"""The README's YAML job spec stays valid."""

from __future__ import annotations

import os

import yaml
from conftest import ROOT

from tidyframe.plans import load_spec


def test_readme_yaml_spec_is_valid():
    with open(os.path.join(ROOT, "README.md"), encoding="utf-8") as fh:
        text = fh.read()
    block = text.split("```yaml\n", 1)[1].split("```", 1)[0]
    spec = load_spec(yaml.safe_load(block))
    assert spec.dedupe.keys == ("patient_id",)
    assert spec.clean.split[0].cast == "int"
    assert spec.quality.report_sink.partition_by == ("run_date",)
