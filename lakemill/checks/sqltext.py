"""SQL fragments whose arithmetic equals that of the jobs."""


def half_up(expression: str, digits: int) -> str:
    """Round a double half-up on its printed decimal value."""
    return f"round(({expression})::varchar::decimal(30,15), {digits})::double"


def cents(expression: str, digits: int = 2) -> str:
    """Order-independent money sum."""
    return f"round(sum(({expression})::decimal(28,6)), {digits})::double"


def flags(condition: str) -> str:
    return f"count(*) FILTER (WHERE {condition})"
