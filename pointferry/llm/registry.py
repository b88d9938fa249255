"""All queries of this subpackage, by name."""

from __future__ import annotations

from pointferry.llm import (
    bpecodec, decontam, fmdedup, jaccard, licenses, lmscore, merkle, packing, prefixtrie, quality, secrets, suffixdedup, tokencount,
)

MODULES = (suffixdedup, packing, jaccard, licenses, tokencount, quality, decontam, fmdedup, secrets, lmscore, prefixtrie, merkle, bpecodec)
ENTRIES = {name: entry for module in MODULES for name, entry in module.ENTRIES.items()}
