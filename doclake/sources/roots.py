"""One-or-many roots of a source."""

from __future__ import annotations

from collections.abc import Sequence


def resolve_roots(
    many: Sequence[str] | None, one: str | None = None, default: Sequence[str] = (), strip: str = ""
) -> list[str]:
    """The listed roots, then the single one, else ``default``; repeats are kept.

    ``strip`` removes those characters from both ends, as object-store prefixes and library folders
    need; a single root that strips to nothing does not count.
    """

    def trimmed(root: str) -> str:
        return root.strip(strip) if strip else root

    roots = [trimmed(r) for r in many or []]
    if one and trimmed(one):
        roots.append(trimmed(one))
    return roots or list(default)
