"""What the training-data operators may bring to the driver, and what they must not use."""

import re
from pathlib import Path

import calltide.llm

# Lines that collect, each bounded by something else than the number of documents.
ALLOWED = {
    "common.py": 1,  # counts of edges of a round
    "crf.py": 1,  # a bounded sample of labelled documents
    "decontaminate.py": 1,  # the benchmark, a block at a time
    "hard_negatives.py": 1,  # four numbers
    "langid.py": 2,  # languages; slots of the filters
    "mixing.py": 2,  # sums of a round
    "run_index.py": 0,
    "suffix_dedup.py": None,
}


def test_only_bounded_results_reach_the_driver():
    for path in sorted(Path(calltide.llm.__file__).parent.glob("*.py")):
        found = [x.strip() for x in path.read_text().splitlines() if re.search(r"\.(collect|toPandas|toLocalIterator|take|first|head)\(", x)]
        found = [x for x in found if not re.search(r"F\.(first|take)\(|np\.take|\.take\(pa|chunk|c\.take", x)]
        limit = ALLOWED.get(path.name, 0)
        assert limit is None or len(found) <= limit, (path.name, found)


def test_nothing_is_cached_on_machines_or_crossed():
    for path in Path(calltide.llm.__file__).parent.glob("*.py"):
        text = path.read_text()
        assert not re.search(r"localCheckpoint|crossJoin|\.rdd\b|\.persist\(|\.cache\(|tempfile", text), path.name
