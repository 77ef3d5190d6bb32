"""Parameters of a run from the command line."""

import pytest

from bookpipe.__main__ import arguments, config_of
from bookpipe.config import RunConfig

PLACES = ["--captures", "in", "--store", "out"]


def test_defaults():
    assert config_of(arguments(PLACES)) == RunConfig(5, 5)


def test_parameters_of_reading():
    config = RunConfig(5, 5, sort_by="reviews", reviews_per_page=10, follow_pager=True)
    assert config_of(arguments(["--sort-by", "reviews", "--reviews-per-page", "10", "--follow-pager", *PLACES])) == config
    for wrong in ({"sort_by": "title"}, {"reviews_per_page": 0}):
        with pytest.raises(ValueError):
            RunConfig(**wrong)
    assert arguments(["--batch", "b1", *PLACES]).batch == "b1"


def test_every_parameter():
    given = "1000 20 --banned gizmo --banned rod --language French --count-mode users --dedup-first --on-error fail"
    config = RunConfig(1000, 20, ("gizmo", "rod"), "French", count_mode="users", dedup_first=True, on_error="fail")
    assert config_of(arguments([*given.split(), *PLACES])) == config


@pytest.mark.parametrize("wrong", [["--count-mode", "books"], ["--on-error", "skip"], ["five"]])
def test_wrong_values_stop(wrong):
    with pytest.raises(SystemExit):
        arguments([*wrong, *PLACES])
