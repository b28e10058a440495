"""Views of the layers (B8): the staging models and ``int_user_metrics`` as SQL.

The same models as the DataFrame functions of :mod:`cartwright.plans.staging` and
:mod:`cartwright.plans.intermediate`, for users of the catalog. ``{raw}`` and the
other layer names are filled in with the databases at registration.
"""

from __future__ import annotations

from cartwright import fixed


def _round(num: str, den: str, digits: int) -> str:
    """round(num / den, digits), half up; exact on integers, NULL over 0."""
    wide = f"CAST({num} AS DECIMAL(38,0)) * {2 * 10 ** digits} + {den}"
    return f"CAST(({wide}) DIV (2 * nullif({den}, 0)) AS DOUBLE) / {10 ** digits}"


def _field(*keys: str, kind: str = "string") -> str:
    path = "$" + "".join(f'["{k}"]' for k in keys)
    return f"variant_get(payload, '{path}', '{kind}')"


_NUTRIMENTS = ", ".join(f"{_field('nutriments', key, kind='double')} AS {name}" for key, name in fixed.NUTRIMENT_FIELDS)
_LOADED = ", ".join(f"'{s}'" for s in fixed.LOADED_EVAL_SETS)
_LINE = "order_id, product_id, add_to_cart_order, reordered, order_number"

#: name -> (layer, SQL)
VIEWS: dict[str, tuple[str, str]] = {
    "stg_aisles": ("staging", "SELECT aisle_id, aisle AS aisle_name FROM {raw}.aisles"),
    "stg_departments": ("staging", "SELECT department_id, department AS department_name FROM {raw}.departments"),
    "stg_products": ("staging", "SELECT product_id, product_name, aisle_id, department_id FROM {raw}.products"),
    "stg_orders": ("staging", f"""
        SELECT order_id, user_id, eval_set, order_number, order_dow AS order_day_of_week, order_hour_of_day,
               CAST(days_since_prior_order AS DOUBLE) AS days_since_prior_order
        FROM {{raw}}.orders WHERE eval_set IN ({_LOADED})"""),
    "stg_order_products": ("staging", f"""
        SELECT {_LINE}, 'prior' AS source FROM {{raw}}.order_products_prior
        UNION ALL SELECT {_LINE}, 'train' AS source FROM {{raw}}.order_products_train"""),
    "stg_off_products": ("staging", f"""
        SELECT * EXCEPT (newest) FROM (
          SELECT {_field("code")} AS product_code, {_field("product_name")} AS product_name,
                 {_field("brands")} AS brands, {_field("categories_tags", kind="variant")} AS categories_tags, {_NUTRIMENTS},
                 last_modified_t, CAST(timestamp_seconds(last_modified_t) AS TIMESTAMP_NTZ) AS last_modified_at,
                 row_number() OVER (PARTITION BY {_field("code")} ORDER BY last_modified_t DESC NULLS FIRST,
                   feed_seq DESC NULLS LAST, _loaded_at DESC NULLS LAST, to_json(payload) DESC NULLS LAST) AS newest
          FROM {{raw}}.off_products_raw WHERE coalesce({_field("code")}, '') <> '')
        WHERE newest = 1"""),
    "int_user_metrics": ("intermediate", f"""
        SELECT user_id, count(DISTINCT o.order_id) AS total_orders,
               {_round("sum(CAST(days_since_prior_order AS DECIMAL(38,0)))", "count(days_since_prior_order)", 2)}
                 AS avg_days_between_orders,
               sum(basket_size) AS total_items_purchased,
               {_round("sum(basket_size)", "count(basket_size)", 2)} AS avg_basket_size,
               {_round("sum(num_reordered)", "sum(basket_size)", 4)} AS reorder_ratio
        FROM {{staging}}.stg_orders o LEFT JOIN {{intermediate}}.int_order_metrics USING (order_id) GROUP BY user_id"""),
}
