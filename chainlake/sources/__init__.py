"""Sources: blocks, archives, objects in files, their priority merge, and following a folder."""

from .archives import read_archives
from .blocks import read_blocks
from .follow import snapshot_then_follow
from .merge import merge_sources
from .objects import list_objects, read_objects

__all__ = ["list_objects", "merge_sources", "read_archives", "read_blocks", "read_objects", "snapshot_then_follow"]
