"""FIXED VALUES: static seed catalogues (SRC-20).

Stated as given, in their natural order.
"""

# Major category ids used to start a category crawl (kept sorted).
MAJOR_CATEGORY_IDS = [
    1, 3, 5, 6, 9, 10, 11, 12, 13, 15, 18, 22, 24, 31, 32, 46, 50, 94, 95, 106, 115, 120, 398,
    32217, 32255, 32263, 32446, 32455, 33060, 33061, 33939, 33951,
]

# Common labour-statistics series: (id, title, survey).
COMMON_LABOUR_SERIES = [
    ("CUUR0000SA0", "CPI All Urban Consumers - All Items", "CU"),
    ("CUUR0000SA0L1E", "CPI All Urban Consumers - All Items Less Food & Energy", "CU"),
    ("CUUR0000SETB01", "CPI All Urban Consumers - Energy", "CU"),
    ("CUUR0000SAF1", "CPI All Urban Consumers - Food", "CU"),
    ("CUUR0000SAA", "CPI All Urban Consumers - Apparel", "CU"),
    ("CUUR0000SAH1", "CPI All Urban Consumers - Shelter", "CU"),
    ("CUUR0000SAM", "CPI All Urban Consumers - Medical Care", "CU"),
    ("CUUR0000SAS", "CPI All Urban Consumers - Services", "CU"),
    ("SUUR0000SA0", "CPI Research - All Items", "SU"),
    ("PCUOMFGOMFG", "PPI - Manufacturing", "PC"),
    ("WPU00000000", "PPI - All Commodities", "WP"),
    ("WPUFD49207", "PPI - Finished Goods", "WP"),
    ("WPUFD49502", "PPI - Intermediate Goods", "WP"),
    ("WPUFD49116", "PPI - Crude Goods", "WP"),
    ("CEU0000000001", "Employment - Total Nonfarm", "CE"),
    ("CES0000000001", "Employment - Total Nonfarm (Alternative)", "CE"),
    ("CEU0500000001", "Employment - Total Private", "CE"),
    ("CEU0600000001", "Employment - Goods Producing", "CE"),
    ("CEU0700000001", "Employment - Service Providing", "CE"),
    ("CEU1000000001", "Employment - Mining and Logging", "CE"),
    ("CEU2000000001", "Employment - Construction", "CE"),
    ("CEU3000000001", "Employment - Manufacturing", "CE"),
    ("LNS14000000", "Unemployment Rate", "LN"),
    ("LNS12000000", "Employment-Population Ratio", "LN"),
    ("LNS11300000", "Labor Force Participation Rate", "LN"),
    ("CES0500000003", "Average Hourly Earnings - Total Private", "CE"),
    ("LEU0254551600", "Average Weekly Earnings", "LE"),
    ("CES0500000011", "Average Weekly Earnings - Total Private", "CE"),
    ("AWHI", "Aggregate Weekly Hours Index", "CE"),
    ("CES0500000002", "Average Weekly Hours - Total Private", "CE"),
    ("CES2000000002", "Average Weekly Hours - Construction", "CE"),
    ("CES3000000002", "Average Weekly Hours - Manufacturing", "CE"),
    ("IWP00000000", "Import Price Index - All Imports", "IW"),
    ("EWP00000000", "Export Price Index - All Exports", "EW"),
]
