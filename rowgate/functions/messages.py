"""Violation message formats.

Fixed values: these texts must equal the original tool's messages word for
word (reports and quarantines are compared and grepped by people and jobs).
``{value}`` is the offending raw value; the other fields are filled from the
contract.
"""

# Violation messages, in rule order.
REQUIRED = "{column}: required field is null or empty"
ALLOWED_VALUES = "{column}: '{value}' not in allowed_values {allowed}"
TYPE = "{column}: '{value}' is not a valid {type}"
REGEX = "{column}: '{value}' does not match pattern {pattern}"
MIN_VALUE = "{column}: {value} is below min_value {bound}"
MAX_VALUE = "{column}: {value} exceeds max_value {bound}"
BUSINESS_RULE = "business_rule: {name} - {message}"
BUSINESS_RULE_FAILED = "business_rule: {name} failed"
DUPLICATE = "{key}: duplicate {key} found across files"

# Messages of checks the original tool did not have.
DUPLICATE_IN_FILE = "{key}: duplicate {key} found within file"
STRICT_SCALE = "{column}: '{value}' has more decimals than {type}"
RULE_ERROR = "business_rule: {name} could not be evaluated"
MALFORMED = "row: wrong number of fields or unclosed quote"


def split(template: str, **fixed) -> tuple[str, str]:
    """Text before and after ``{value}`` with the fixed fields filled in."""
    before, after = template.split("{value}")
    return before.format(**fixed), after.format(**fixed)
