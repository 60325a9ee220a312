"""Resource limits, all in one frozen record."""

from __future__ import annotations

from dataclasses import dataclass

KIB, MIB, GIB = 1024, 1024**2, 1024**3


@dataclass(frozen=True)
class Limits:
    # Limits of files, sessions, parsers, archives and answers.
    file_bytes: int = 50 * MIB
    snapshot_bytes: int = 128 * MIB
    folder_bytes: int = 100 * MIB
    session_files: int = 20
    session_bytes: int = GIB
    chunk_bytes: int = 768 * KIB
    uploads: int = 8
    idle_seconds: int = 120
    decompressed_bytes: int = 256 * MIB
    archive_entries: int = 10_000
    ratio: int = 100
    ratio_from_bytes: int = MIB
    xml_nodes: int = 2_000_000
    parse_seconds: float = 30.0
    preview_chars: int = 4000
    search_items: int = 50
    query_items: int = 2000
    rows_per_block: int = 500
    stream_bytes: int = 20 * MIB
    text_lines: int = 400
    outline_window: int = 200
    block_lines: int = 2000
    entry_text_bytes: int = 8 * MIB
    entry_search_bytes: int = 32 * MIB
    entry_search_files: int = 500
    entry_outline: int = 2000
    entry_lines: int = 2000
    entry_chars: int = 200_000
    window_lines: int = 400
    window_line_chars: int = 2000
    window_bytes: int = 48 * KIB
    image_side: int = 2000
    image_patches: int = 2500
    patch: int = 32


LIMITS = Limits()


class QueryError(ValueError):
    """An invalid request or input; ``code`` is one of the public error codes."""

    def __init__(self, code: str, message: str = ""):
        super().__init__(f"{code}: {message}" if message else code)
        self.code = code
