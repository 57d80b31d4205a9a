"""Problem 6: copies of a few words."""

import pytest

from foreglass.llm.defects import Prompt, defect

TITLE = "Who wins the cup in Balarmere?"


@pytest.mark.parametrize("answer,kind", [("The cup in Balarmere.", "copy"), ("WINS the cup.", "copy"), ("Balarmere.", "copy"), ("The cup in Fenorford.", None), ("Balarmere in the cup.", None)])
def test_short_copies(languages, answer, kind):
    assert defect(answer, Prompt([TITLE, None], None, languages)) == kind
