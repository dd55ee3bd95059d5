from crownlake.functions.columns import (  # noqa: F401
    battle_id,
    card_names,
    clamp_at_zero,
    clean_tag,
    count_if,
    deck_hash,
    falsy_default,
    first_or_null,
    guarded_pct,
    is_win,
    multiplicity,
    outcome_label,
    parse_api_time,
    parse_deck,
    pct,
    render_api_time,
    render_deck,
    result_from_crowns,
    strip_mark,
    to_date_or_null,
    to_number,
)
