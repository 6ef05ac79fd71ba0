"""Independent plain-Python expectations for small tables."""

from bisect import bisect_left

LABELS = ("Very Low", "Low", "High", "Very High")


def order_statistic(ordered, share):
    """Linear interpolation between neighbours of a sorted list."""
    place = share * (len(ordered) - 1)
    below = int(place)
    above = min(below + 1, len(ordered) - 1)
    return ordered[below] + (place - below) * (ordered[above] - ordered[below])


def quartile_labels(values):
    """A label per value from quartile cuts of the values within the fences."""
    known = sorted(v for v in values if v is not None)
    cuts = []
    if len(set(known)) > 1:
        low, high = order_statistic(known, 0.25), order_statistic(known, 0.75)
        reach = 1.5 * (high - low)
        usual = [v for v in known if low - reach <= v <= high + reach]
        cuts = sorted({order_statistic(usual, k / 4) for k in range(5)})

    def label(v):
        if len(cuts) < 2 or v is None or v < cuts[0] or v > cuts[-1]:
            return "Unknown"
        return LABELS[max(0, bisect_left(cuts, v) - 1)]

    return [label(v) for v in values]


def customer_rows(lines):
    """Expected feature values per customer from a list of invoice-line rows."""
    by_customer = {}
    for line in lines:
        by_customer.setdefault(line["CustomerID"], []).append(line)
    newest = max(line["InvoiceDate"] for line in lines)
    out = {}
    for who, own in by_customer.items():
        days = sorted(line["InvoiceDate"] for line in own)
        orders = len({line["InvoiceNo"] for line in own})
        quantity = sum(line["Quantity"] for line in own)
        spending = sum(line["Quantity"] * line["UnitPrice"] for line in own)
        returned = -sum(line["Quantity"] for line in own if line["Quantity"] < 0)
        tenure = (days[-1] - days[0]).days
        out[who] = {"num_orders": orders, "total_quantity": quantity, "product_diversity": len({line["StockCode"] for line in own}),
                    "recency": (newest - days[-1]).days, "customer_tenure": tenure, "total_spending": spending,
                    "avg_order_value": spending / orders, "order_frequency": tenure / orders, "return_rate": returned / quantity}
    names = list(out)
    for binned, source in (("total_sales_bin", "total_spending"), ("recency_bin", "recency"),
                           ("customer_tenure_bin", "customer_tenure"), ("order_frequency_bin", "order_frequency")):
        for who, label in zip(names, quartile_labels([float(out[n][source]) for n in names])):
            out[who][binned] = label
    return out
