"""Tag lists to tag maps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TAG_LIST = "array<map<string,string>>"
TAG_MAP = "map<string,string>"
ROLE_TAG = "instance_role"


def tags_to_map(tags: Column, key_name: str, value_name: str) -> Column:
    """Turn `[{key_name: k, value_name: v}, ...]` (`array<map<string,string>>`) into `{k: v}`.

    A null list gives null; elements lacking either name are skipped; the last
    element with a key wins, in the place of the first.
    """
    def to_map(usable: Column) -> Column:
        keys = F.array_distinct(F.transform(usable, lambda t: t[key_name]))
        values = F.transform(
            keys,
            lambda k: F.element_at(F.filter(usable, lambda t: t[key_name] == k), -1)[value_name],
        )
        return F.map_from_arrays(keys, values)

    usable = F.filter(
        tags,
        lambda t: F.map_contains_key(t, F.lit(key_name))
        & F.map_contains_key(t, F.lit(value_name))
        & t[key_name].isNotNull(),
    )
    # As a lambda's argument the list is read once; as an expression it would be read again for each key.
    return F.transform(F.array(usable), to_map)[0]


def tag(tags: Column, key: str = ROLE_TAG) -> Column:
    """One tag of a tag map, null when it is not set."""
    return tags[key]
