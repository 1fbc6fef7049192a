"""Constants and value lists of the star derivation, stated for the SQL side on their own."""

JD_1998 = 2450815          # date key of 1998-01-01 (Julian day number)
JD_2000 = 2451545          # date key of 2000-01-01
YEAR_LO, YEAR_HI = 1998, 2000   # the calendar covers at least the snapshot years
YEARS_BEFORE, YEARS_AFTER = 1, 2          # and these around the orders (returns, shipping, same day last year)
N_INCOME, N_BUY, N_DEP, N_VEHICLE = 20, 6, 10, 6
N_HDEMO = N_INCOME * N_BUY * N_DEP * N_VEHICLE                      # 7,200
N_CDEMO = 2 * 5 * 7 * 20 * 4 * 7 * 7 * 7                            # 1,920,800
CDEMO_STEP, HDEMO_STEP = 27449, 2969      # no common factor with the sizes: customers spread over all rows
N_STORE, N_CALL_CENTER, N_CATALOG_PAGE = 12, 6, 120
N_WEB_SITE, N_WEB_PAGE, N_WAREHOUSE = 30, 60, 5
N_SHIP_MODE, N_REASON, N_PROMO = 20, 35, 30
INV_WEEKS = 157            # weekly snapshots, Thursdays 1998-01-01 .. 2000-12-28
# Order numbers: four for each source order, one for each way a sale comes about
# (3: a fresh purchase of the refresh feeds), so no two sales share a number.
KINDS, BASE_ORDER, CATALOG_REPURCHASE, WEB_REPURCHASE, FRESH_PURCHASE = 4, 0, 1, 2, 3
# Re-purchases draw their attributes by the same rules from a shifted number.
RULE_SHIFT = {CATALOG_REPURCHASE: 10_000_000, WEB_REPURCHASE: 20_000_000}

# ---------------------------------------------------------------------------
# Fixed values. Demographic value lists and day names must equal the retail
# benchmark's domain values (queries filter on them):
GENDERS = ["M", "F"]
MARITAL = ["M", "S", "D", "W", "U"]
EDUCATION = ["Primary", "Secondary", "College", "2 yr Degree", "4 yr Degree",
             "Advanced Degree", "Unknown"]
CREDIT = ["Good", "High Risk", "Low Risk", "Unknown"]
BUY_POTENTIAL = ["0-500", "501-1000", "1001-5000", "5001-10000", ">10000", "Unknown"]
DAY_NAMES = ["Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday"]
SHIP_TYPES = ["EXPRESS", "NEXT DAY", "OVERNIGHT", "REGULAR", "TWO DAY", "LIBRARY"]
SHIP_CODES = ["AIR", "SURFACE", "SEA"]
SIZES = ["petite", "small", "medium", "large", "extra large", "economy", "N/A"]
WEB_PAGE_TYPES = ["general", "order", "welcome", "ad", "feedback", "protected", "dynamic"]
LOCATION_TYPES = ["single family", "condo", "apartment"]
CLASSES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]          # of the part table
CATEGORIES = ["anvil", "bolt", "gear", "gizmo", "plate", "ring", "rod", "widget"]
# Our own labels:
STATES = ["AL", "AK", "AZ", "AR", "CA", "CO", "CT", "DE", "FL", "GA", "HI", "ID", "IL",
          "IN", "IA", "KS", "KY", "LA", "ME", "MD", "MA", "MI", "MN", "MS", "MO"]
CITIES = ["Ambervale", "Birchport", "Copperton", "Dunmoor", "Elkhaven", "Foxbridge", "Gullwick", "Heronsford",
          "Inkwell", "Juniper Bay"]
STREETS = ["Main", "Oak", "Park", "Elm", "Lake", "Hill", "Pine", "Cedar"]
STREET_TYPES = ["Street", "Avenue", "Road", "Lane", "Court"]
FIRST_NAMES = ["James", "Mary", "John", "Linda", "Robert", "Susan", "Michael", "Karen",
               "David", "Lisa", "William", "Nancy", "Richard", "Betty", "Joseph",
               "Helen", "Thomas", "Sandra", "Charles", "Donna"]
LAST_NAMES = ["Smith", "Johnson", "Brown", "Jones", "Miller", "Davis", "Garcia", "Wilson",
              "Moore", "Taylor", "Anderson", "Thomas", "Jackson", "White", "Harris",
              "Martin", "Thompson", "Young", "Allen", "King"]
SALUTATIONS = ["Mx.", "Prof.", "Capt.", "Rev."]
STORE_NAMES = ["corner", "harbor", "meadow", "summit", "orchard", "canal"]
UNITS = ["Each", "Dozen", "Box", "Case", "Pallet", "Lb", "Oz", "Gram"]
CARRIERS = [f"Carrier {c}" for c in "ABCDEFGHIJKLMNOPQRST"]
WAREHOUSES = ["Harbor depot", "Ridge depot", "Valley depot", "Summit depot", "Prairie depot"]
CALL_CENTERS = ["North", "South", "East", "West", "Central", "Pacific"]
PROMO_NAMES = [f"campaign {k}" for k in range(10)]
SITE_COMPANIES = [f"company {k}" for k in range(6)]
# ---------------------------------------------------------------------------

TABLES = ["date_dim", "time_dim", "item", "store", "customer", "customer_address",
          "customer_demographics", "household_demographics", "income_band", "promotion",
          "warehouse", "ship_mode", "reason", "call_center", "catalog_page", "web_site",
          "web_page", "store_sales", "store_returns", "catalog_sales", "catalog_returns",
          "web_sales", "web_returns", "inventory"]
MONEY_COLS = ["wholesale_cost", "list_price", "sales_price", "ext_discount_amt",
              "ext_sales_price", "ext_wholesale_cost", "ext_list_price", "ext_tax",
              "coupon_amt", "ext_ship_cost", "net_paid", "net_paid_inc_tax",
              "net_paid_inc_ship", "net_paid_inc_ship_tax", "net_profit"]
