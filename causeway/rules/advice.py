"""Default advisory wording, the same short text for every label. Callers put their own into a pack.

Nothing here is computed on: the texts are attached to summaries and profiles.
"""

ACTIONS = ["Note since when it occurs and which services report it",
           "Compare with the last change rolled out to them",
           "Hand the evidence to the owner of the first service affected"]
IMPACT = "As wide as the set of services that report it"
CATEGORY_TEXT = "The examples and phrases below show what its logs have in common."
ISSUES = ["What the examples of this category show"]
