"""How the driver tables stand in for the original inputs (see FIXTURES.md)."""

# events as readings: event types play the pollutants; "purchase" plays the role of
# the unit-corrected measure (CO, divided by 1000 in the original analysis)
EVENT_MEASURES = ("click", "error", "purchase", "signup", "view")
EVENT_SCALE = {"purchase": 0.001}
VALID_LOW, VALID_HIGH = 0.0, 1000.0

# lineitem as a wide numeric table
LINEITEM_MEASURES = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
