"""SQL on element ids: the number of ``h-1`` is 1, that of ``p-3`` is 3."""


def has_id(node_id):
    return f"coalesce({node_id} <> '', false)"


def _after_dash(node_id):
    return f"try_cast(split_part({node_id}, '-', 2) as bigint)"


def id_number(node_id, undashed="0"):
    """The number after the dash; ``undashed`` for an id without one; null for no id."""
    return (
        f"case when {node_id} = '' then null when contains({node_id}, '-') "
        f"then {_after_dash(node_id)} when {node_id} is not null "
        f"then cast({undashed} as bigint) end"
    )


def id_is_broken(node_id):
    """True where a dash is followed by something that is no number."""
    return f"coalesce(contains({node_id}, '-') and {_after_dash(node_id)} is null, false)"
