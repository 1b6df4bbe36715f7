"""Fixed values shared by plans and checks."""

# Name of the organization column; functions that read it take another name as ``org``.
ORG = "organization_id"

# Organization of masked rows, and the shortest phone number that is kept.
MASKED_ORG = "org_pii_masking"
SHORTEST_NUMBER = 7
