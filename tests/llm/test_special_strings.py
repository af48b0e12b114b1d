"""A vocabulary with several special strings is refused, not split by one of them."""

from types import SimpleNamespace

import pytest

from quartermaster.llm import bpe


def test_several_special_strings_are_refused():
    with pytest.raises(ValueError, match="special"):
        bpe.one_special(SimpleNamespace(special={"<s>": 1, "</s>": 2}))
    assert bpe.one_special(SimpleNamespace(special={"<s>": 1})) == "<s>" and bpe.one_special(SimpleNamespace(special={})) is None
