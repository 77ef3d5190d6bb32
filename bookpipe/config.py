"""Run parameters."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class RunConfig:
    """What one run must reach, and how.

    ``num_books`` and ``num_reviews`` are totals over everything saved so far,
    so repeating a run with the same numbers adds nothing and repeating it with
    larger ones tops up.
    """

    num_books: int = 5
    num_reviews: int = 10
    banned_titles: tuple[str, ...] = ()
    language: str = "English"
    surplus: float = 0.05
    # A1: "rows" counts stored review rows, "users" counts distinct reviewers and
    # also keeps books without any review.
    count_mode: str = "rows"
    # False: the quota is counted on candidates, repeats by one user included.
    dedup_first: bool = False
    # Books in the order they are listed in, or most reviewed first, by their captured pages.
    sort_by: str = "listing"
    # Complete reviews to expect on a review page: how many pages are read at first.
    reviews_per_page: int = 1
    # Whether a book's pages end at the first whose pager has no next page.
    follow_pager: bool = False
    # "quarantine" sets bad pages aside, "fail" aborts the job on the first one.
    on_error: str = "quarantine"

    def __post_init__(self) -> None:
        if isinstance(self.banned_titles, str):
            raise ValueError("banned_titles must be a list of phrases")
        if self.num_books < 0 or self.num_reviews < 0:
            raise ValueError("num_books and num_reviews must not be negative")
        if self.sort_by not in ("listing", "reviews"):
            raise ValueError(f"unknown sort_by {self.sort_by!r}")
        if self.reviews_per_page < 1:
            raise ValueError("reviews_per_page must be positive")
        if self.count_mode not in ("rows", "users"):
            raise ValueError(f"unknown count_mode {self.count_mode!r}")
        if self.on_error not in ("quarantine", "fail"):
            raise ValueError(f"unknown on_error {self.on_error!r}")
        object.__setattr__(self, "banned_titles", tuple(self.banned_titles or ()))
