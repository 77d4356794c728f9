"""Job settings: one immutable value handed to every plan."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

# Spellings that switch a flag off; anything else switches it on.
_OFF_WORDS = {"0", "false", "no"}


@dataclass(frozen=True)
class JobConfig:
    """Settings that change results.

    ``letter``            initial every title must have (case-insensitive)
    ``target_rows``       rows a collect run must deliver
    ``pool_rows``         size of the popularity pool, ``None`` = 3 x target
    ``enrich_limit``      deepest rank that gets a page lookup, ``None`` = target
    ``require_page``      strict mode: rows without a page are dropped
    ``batch_rows``        rows one enrich run may attempt, ``None`` = all
    ``checkpoint_rows``   responses per streaming micro-batch
    ``search_limit``      pages asked for per lookup
    ``retry_failed``      visit known failures instead of new rows
    """

    letter: str = "M"
    target_rows: int = 10_000
    pool_rows: int | None = None
    enrich_limit: int | None = None
    require_page: bool = False
    batch_rows: int | None = 250
    checkpoint_rows: int = 10
    search_limit: int = 1
    retry_failed: bool = False
    title_type: str = "movie"
    actor_category: str = "actor"
    max_year: int = 2024
    min_runtime: int = 60
    max_runtime: int = 300
    max_actors: int = 5

    @property
    def pool_size(self) -> int:
        return 3 * self.target_rows if self.pool_rows is None else self.pool_rows

    @property
    def lookup_depth(self) -> int:
        return self.target_rows if self.enrich_limit is None else self.enrich_limit

    @classmethod
    def from_settings(cls, settings: Mapping[str, str], *, drain: bool = False) -> JobConfig:
        """Read the published setting names; ``drain`` picks the loop defaults."""

        def flag(name: str, default: str) -> bool:
            return settings.get(name, default).strip().lower() not in _OFF_WORDS

        def number(name: str, default: int | None) -> int | None:
            text = settings.get(name)
            return default if text is None else int(text)

        initial = settings.get("TEAM_LETTER", "").strip()[:1]
        return cls(
            letter=initial.upper() if initial else cls.letter,
            target_rows=number("TARGET_MOVIE_COUNT", 10_000),
            pool_rows=number("CANDIDATE_POOL_SIZE", None),
            enrich_limit=number("WIKIPEDIA_ENRICH_LIMIT", None),
            require_page=flag("REQUIRE_WIKIPEDIA_PAGE", "0"),
            batch_rows=number("ENRICH_BATCH_SIZE", 500 if drain else 250),
            checkpoint_rows=number("ENRICH_SAVE_EVERY", 10),
            search_limit=number("WIKI_SEARCH_LIMIT", 8 if drain else 1),
            retry_failed=flag("ENRICH_RETRY_FAILED", "1" if drain else "0"),
        )
