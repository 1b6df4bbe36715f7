"""SQL building blocks of the checks. Every block is a named common table expression."""

from __future__ import annotations

import re
from collections.abc import Mapping

from workload.shapes import SHAPES

NO_TAG = "regexp_replace(occupation, '⟦[pP]:[^⟧]+⟧', '', 'g')"
DIGITS = "regexp_replace(regexp_replace(number, '⟦PH:[^⟧]+⟧', '', 'g'), '[^0-9]', '', 'g')"


def local(ts: str, zone: str) -> str:
    """UTC to local for the zones of the shapes; two of them have clock changes."""
    hours = f"case lower({zone}) when 'asia/jakarta' then 7 when 'asia/makassar' then 8 else 0 end"
    changing = f"timezone({zone}, timezone('UTC', {ts}))"
    return f"(case when {zone} in ('Europe/Berlin', 'America/New_York') then {changing} else {ts} + interval 1 hour * {hours} end)"


def initcap(c: str) -> str:
    words = f"list_filter(string_split_regex(trim({c}), '\\s+'), lambda w: w <> '')"
    return f"array_to_string(list_transform({words}, lambda w: upper(w[1]) || lower(w[2:])), ' ')"


def shown(c: str, word: str = "Unknown") -> str:
    """Formatted text: missing words and blanks become a word, others are capitalized."""
    missing = f"{c} is null or lower(trim({c})) in ('', '<na>', 'nan', 'none')"
    return f"case when {missing} then '{word}' else {initcap(c)} end"


def filled(c: str, word: str = "Unknown") -> str:
    return f"case when trim(coalesce({c}, '')) = '' then '{word}' else {c} end"


def text(c: str) -> str:
    """Cleaned text column: trimmed, missing words to null."""
    return f"case when trim({c}) in ('nan', 'NaN', 'None', '') then null else trim({c}) end"


EPOCH = "timestamp '1970-01-01 00:00:00'"

BLOCKS = {name: shape.sql() for name, shape in SHAPES.items()}

BLOCKS |= {
    # silver and gold
    "clean_employments": f"""
        SELECT trim(contact_id) AS contact_id, nullif(trim(employer_name), '') AS employer_name,
          nullif(trim(title), '') AS title, nullif(lower(trim({NO_TAG})), '') AS occupation, start_date,
          try_cast(end_date AS date) AS end_date, coalesce(is_current, false) AS is_current,
          trim(organization_id) AS organization_id, processing_date, row_id FROM employments_raw""",
    "best_employments": """
        SELECT * FROM clean_employments QUALIFY row_number() OVER (PARTITION BY contact_id, occupation, start_date
          ORDER BY is_current DESC, processing_date DESC, row_id) = 1""",
    "silver_employments": """
        SELECT * EXCLUDE (row_id) FROM best_employments
        WHERE occupation IS NOT NULL AND organization_id <> 'org_pii_masking'""",
    "clean_phones": f"""
        SELECT trim(contact_id) AS contact_id, lower(trim(label)) AS label, {DIGITS} AS number,
          trim(organization_id) AS organization_id, processing_date, row_id FROM phones_raw""",
    "best_phones": """
        SELECT * FROM clean_phones
        QUALIFY row_number() OVER (PARTITION BY contact_id, number ORDER BY processing_date DESC, row_id) = 1""",
    "silver_phones": """
        SELECT * EXCLUDE (row_id) FROM best_phones
        WHERE contact_id IS NOT NULL AND number IS NOT NULL AND length(number) >= 7""",
    "without_phone": """
        SELECT DISTINCT contact_id, organization_id FROM silver_employments e
        WHERE NOT EXISTS (SELECT 1 FROM silver_phones p WHERE p.contact_id = e.contact_id)""",
    # cleaned referral tables
    "c_referrals": f"""
        SELECT coalesce(referral_at, {EPOCH}) AS referral_at, referral_id, coalesce({text('referee_id')}, '') AS referee_id,
          coalesce({text('referee_name')}, '') AS referee_name, coalesce(referee_phone, '') AS referee_phone,
          coalesce(referral_reward_id, 0) AS referral_reward_id, referral_source,
          coalesce({text('referrer_id')}, '') AS referrer_id, coalesce({text('transaction_id')}, '') AS transaction_id,
          coalesce(updated_at, {EPOCH}) AS updated_at, user_referral_status_id FROM referrals""",
    "c_logs": f"""
        SELECT id, user_referral_id, coalesce({text('source_transaction_id')}, '') AS source_transaction_id, created_at,
          is_reward_granted FROM logs""",
    "c_users": """
        SELECT id, user_id, trim(name) AS name, phone_number, homeclub, timezone_homeclub, membership_expired_date,
          coalesce(is_deleted, false) AS is_deleted FROM users""",
    "c_transactions": """
        SELECT transaction_id, transaction_status, transaction_at, trim(transaction_location) AS transaction_location,
          timezone_transaction, transaction_type FROM transactions""",
    "c_leads": f"""
        SELECT id, lead_id, coalesce({text('source_category')}, '') AS source_category, created_at, preferred_location,
          timezone_location, current_status FROM leads""",
    "c_rewards": """
        SELECT id, coalesce(try_cast(reward_value AS double), 0) AS reward_value, created_at, reward_type FROM rewards""",
    # one row per key, and zones
    "latest_logs": """
        SELECT * FROM c_logs
        QUALIFY row_number() OVER (PARTITION BY user_referral_id ORDER BY created_at DESC, id) = 1""",
    "latest_users": """
        SELECT * FROM c_users
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY membership_expired_date DESC, id) = 1""",
    "latest_leads": """
        SELECT * FROM c_leads QUALIFY row_number() OVER (PARTITION BY lead_id ORDER BY created_at DESC, id) = 1""",
    "zones": """
        SELECT user_id, timezone_homeclub FROM c_users
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY id DESC) = 1""",
    "zoned_referrals": """
        SELECT r.*, a.timezone_homeclub AS timezone_referrer, b.timezone_homeclub AS timezone_referee,
          coalesce(a.timezone_homeclub, b.timezone_homeclub) AS timezone
        FROM c_referrals r LEFT JOIN zones a ON r.referrer_id = a.user_id LEFT JOIN zones b ON r.referee_id = b.user_id""",
    "zoned_logs": """
        SELECT l.*, z.timezone_homeclub FROM c_logs l LEFT JOIN c_referrals r ON l.user_referral_id = r.referral_id
        LEFT JOIN zones z ON r.referrer_id = z.user_id""",
    # local time
    "l_users": f"SELECT * REPLACE ({local('membership_expired_date', 'timezone_homeclub')} AS membership_expired_date) FROM c_users",
    "l_latest_users": """
        SELECT * FROM l_users
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY membership_expired_date DESC, id) = 1""",
    "l_transactions": f"SELECT * REPLACE ({local('transaction_at', 'timezone_transaction')} AS transaction_at) FROM c_transactions",
    "l_leads": f"SELECT * REPLACE ({local('created_at', 'timezone_location')} AS created_at) FROM c_leads",
    "l_latest_leads": """
        SELECT * FROM l_leads QUALIFY row_number() OVER (PARTITION BY lead_id ORDER BY created_at DESC, id) = 1""",
    "l_referrals": f"""
        SELECT * EXCLUDE (timezone_referrer, timezone_referee, timezone)
          REPLACE ({local('referral_at', 'timezone')} AS referral_at, {local('updated_at', 'timezone')} AS updated_at)
        FROM zoned_referrals""",
    "l_logs": f"""
        SELECT * EXCLUDE (timezone_homeclub) REPLACE ({local('created_at', 'timezone_homeclub')} AS created_at)
        FROM zoned_logs""",
    "l_latest_logs": """
        SELECT * FROM l_logs
        QUALIFY row_number() OVER (PARTITION BY user_referral_id ORDER BY created_at DESC, id) = 1""",
    # the wide table and what follows
    "wide": """
        SELECT r.*, g.id, g.user_referral_id, g.source_transaction_id, g.created_at, g.is_reward_granted,
          s.description, s.created_at AS created_at_status, w.reward_value, w.created_at AS created_at_reward, w.reward_type,
          t.transaction_status, t.transaction_at, t.transaction_location, t.timezone_transaction, t.transaction_type,
          a.id AS id_referrer, a.name AS name_referrer, a.phone_number AS phone_number_referrer,
          a.homeclub AS homeclub_referrer, a.timezone_homeclub AS timezone_homeclub_referrer,
          a.membership_expired_date AS membership_expired_date_referrer, a.is_deleted AS is_deleted_referrer,
          b.id AS id_referee, b.name AS name_referee, b.phone_number AS phone_number_referee,
          b.homeclub AS homeclub_referee, b.timezone_homeclub AS timezone_homeclub_referee,
          b.membership_expired_date AS membership_expired_date_referee, b.is_deleted AS is_deleted_referee,
          d.lead_id, d.source_category, d.created_at AS created_at_lead, d.preferred_location, d.timezone_location,
          d.current_status
        FROM l_referrals r
        LEFT JOIN l_latest_logs g ON r.referral_id = g.user_referral_id
        LEFT JOIN statuses s ON r.user_referral_status_id = s.id
        LEFT JOIN c_rewards w ON r.referral_reward_id = w.id
        LEFT JOIN l_transactions t ON r.transaction_id = t.transaction_id
        LEFT JOIN l_latest_users a ON r.referrer_id = a.user_id
        LEFT JOIN l_latest_users b ON r.referee_id = b.user_id
        LEFT JOIN l_latest_leads d ON r.referee_id = d.lead_id""",
    "categorized": """
        SELECT *, case when lower(trim(referral_source)) = 'user sign up' then 'Online'
          when lower(trim(referral_source)) = 'draft transaction' then 'Offline'
          when trim(source_category) <> '' then source_category else '' end AS referral_source_category FROM wide""",
    "ruled": """
        SELECT *, coalesce(reward_value > 0, false) AS rule_reward_positive,
          coalesce(lower(trim(description)) = 'berhasil', false) AS rule_status_success,
          coalesce(trim(transaction_id) <> '', false) AS rule_transaction_exists,
          coalesce(lower(trim(transaction_status)) = 'paid', false) AS rule_transaction_paid,
          coalesce(lower(trim(transaction_type)) = 'new', false) AS rule_transaction_new,
          coalesce(transaction_at > referral_at, false) AS rule_transaction_after_referral,
          coalesce(year(transaction_at) = year(referral_at) AND month(transaction_at) = month(referral_at), false)
            AS rule_same_month,
          coalesce(membership_expired_date_referrer > transaction_at, false) AS rule_membership_active,
          NOT coalesce(is_deleted_referrer, false) AS rule_referrer_not_deleted,
          coalesce(lower(trim(is_reward_granted)) IN ('true', '1', 'yes', 'y'), false) AS rule_reward_granted
        FROM categorized""",
    "judged": """
        SELECT *, rule_reward_positive AND rule_status_success AND rule_transaction_exists AND rule_transaction_paid
          AND rule_transaction_new AND rule_transaction_after_referral AND rule_same_month AND rule_membership_active
          AND rule_referrer_not_deleted AND rule_reward_granted AS is_business_logic_valid FROM ruled""",
    "report": f"""
        SELECT {filled('referral_id')} AS referral_id, referral_at, {shown('referral_source')} AS referral_source,
          {shown('referral_source_category')} AS referral_source_category, user_referral_status_id,
          {shown('description')} AS description, cast(referral_reward_id AS double) AS referral_reward_id,
          cast(coalesce(reward_type, 0) AS double) AS reward_type, coalesce(reward_value, 0) AS reward_value,
          {shown('is_reward_granted')} AS is_reward_granted, {filled('transaction_id')} AS transaction_id,
          {shown('transaction_status')} AS transaction_status, {shown('transaction_type')} AS transaction_type,
          coalesce(transaction_at, {EPOCH}) AS transaction_at, {shown('transaction_location')} AS transaction_location,
          {filled('referrer_id')} AS referrer_id, {shown('name_referrer')} AS name_referrer,
          {filled('phone_number_referrer')} AS phone_number_referrer,
          {filled('homeclub_referrer', 'UNKNOWN')} AS homeclub_referrer,
          coalesce(membership_expired_date_referrer, {EPOCH}) AS membership_expired_date_referrer,
          {shown('cast(is_deleted_referrer AS varchar)')} AS is_deleted_referrer, {filled('referee_id')} AS referee_id,
          {shown('referee_name')} AS referee_name, {filled('referee_phone')} AS referee_phone,
          {filled('homeclub_referee', 'UNKNOWN')} AS homeclub_referee,
          coalesce(membership_expired_date_referee, {EPOCH}) AS membership_expired_date_referee,
          {shown('cast(is_deleted_referee AS varchar)')} AS is_deleted_referee, {shown('source_category')} AS source_category,
          {shown('preferred_location')} AS preferred_location, {shown('current_status')} AS current_status,
          is_business_logic_valid FROM judged""",
    # emails
    "sent_emails": """
        SELECT * REPLACE (trim(subject) AS subject, trim(email_status) AS email_status,
          try_cast(replace("timestamp", '+07:00', '') AS timestamp) - interval 7 hour AS "timestamp") FROM emails""",
}


def build(body: str, other: Mapping[str, str] | None = None) -> str:
    """The body with the blocks it uses, directly or through others, in front; ``other`` replaces some of them."""
    given, needed = BLOCKS | dict(other or {}), []

    def visit(sql: str) -> None:
        for name in given:
            if name not in needed and re.search(rf"\b(FROM|JOIN)\s+{name}\b", sql, re.IGNORECASE):
                visit(given[name])
                needed.append(name)

    visit(body)
    blocks = ", ".join(f"{name} AS ({given[name].strip()})" for name in needed)
    return f"WITH {blocks} {body}" if needed else body
