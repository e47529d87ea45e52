"""What a remote client lacks is not used outside ``clientele/llm``."""

import re
from pathlib import Path

import clientele

ROOT = Path(clientele.__file__).parent


def test_no_module_reaches_into_the_jvm():
    found = [
        f"{path.relative_to(ROOT)}: {name}"
        for path in sorted(ROOT.rglob("*.py"))
        if "llm" not in path.relative_to(ROOT).parts
        for name in re.findall(r"_jvm|_jsparkSession|_jdf|\b_jc\b|sparkContext|\.rdd\b|_sc\b", path.read_text())
    ]
    assert found == []
