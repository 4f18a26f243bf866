"""Contact-campaign effectiveness on PySpark.

Messages sent to overdue loan agreements are matched with daily snapshots of
the loan book, judged by whether the agreement recovered, classified by channel
and outcome, and summarised per product, instalment, channel and area.
"""

from reachbook.campaign import Campaign
from reachbook.functions.calendar import AsOf

__all__ = ["AsOf", "Campaign"]
