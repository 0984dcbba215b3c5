from tessera.functions.conform import (  # noqa: F401
    conform_country, norm_email, money, rate, usd_amount,
)
from tessera.functions.dates import (  # noqa: F401
    utc_date, fiscal_columns, date_spine,
)
