"""Fixed values of the reports' output contract.

These must equal the reference's outputs for the results to match; they are
collected here, in one place, and imported wherever a default is applied.
"""

import datetime as dt

# --- fixed values (output contract) ----------------------------------------
UNKNOWN = "Unknown"                    # missing text attribute, city, status, tenant
UNCATEGORISED = "Uncategorised"        # missing category/subcategory in the P&L and daily dashboards
MISSING_PRODUCT_ID = "productid"       # missing product id in the item P&L dashboards
BLINKIT_INVENTORY_NO_PRODUCT_ID = ""   # missing product id in the Blinkit inventory report
NO_DATE = dt.date(1970, 1, 1)          # missing appointment / expiry date of a purchase order
PERCENT = 100                          # margins and tax rates are given in percent
