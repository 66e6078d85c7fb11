"""The retail rules once more, for the audit's SQL alone: nothing here comes from the audited code."""

from __future__ import annotations

# Table; kind; rule; permitted texts or condition.
RULES = """
USER; NOT NULL; user_id
USER; NOT NULL; username
USER; NOT NULL; password_hash
USER; NOT NULL; full_name
USER; NOT NULL; email
USER; NOT NULL; role
USER; NOT NULL; is_active
USER; NOT NULL; created_at
USER; NOT NULL; updated_at
USER; LENGTH; username <= 50
USER; LENGTH; password_hash <= 255
USER; LENGTH; full_name <= 100
USER; LENGTH; email <= 100
USER; LENGTH; phone <= 20
USER; DOMAIN; role; Admin, Sales
USER; UNIQUE; user_id
USER; UNIQUE; username
USER; UNIQUE; email
CUSTOMER; NOT NULL; customer_id
CUSTOMER; NOT NULL; phone_number
CUSTOMER; NOT NULL; full_name
CUSTOMER; NOT NULL; membership_tier
CUSTOMER; NOT NULL; total_points
CUSTOMER; NOT NULL; registered_at
CUSTOMER; NOT NULL; updated_at
CUSTOMER; LENGTH; phone_number <= 20
CUSTOMER; LENGTH; full_name <= 100
CUSTOMER; LENGTH; email <= 100
CUSTOMER; DOMAIN; membership_tier; Silver, Gold, Diamond
CUSTOMER; CHECK; chk_total_points; total_points >= 0
CUSTOMER; UNIQUE; customer_id
CUSTOMER; UNIQUE; phone_number
STORE; NOT NULL; store_id
STORE; NOT NULL; store_code
STORE; NOT NULL; store_name
STORE; NOT NULL; address
STORE; NOT NULL; city
STORE; NOT NULL; is_active
STORE; NOT NULL; created_at
STORE; LENGTH; store_code <= 20
STORE; LENGTH; store_name <= 100
STORE; LENGTH; address <= 255
STORE; LENGTH; city <= 50
STORE; LENGTH; phone <= 20
STORE; UNIQUE; store_id
STORE; UNIQUE; store_code
PRODUCT; NOT NULL; product_id
PRODUCT; NOT NULL; sku
PRODUCT; NOT NULL; barcode
PRODUCT; NOT NULL; product_name
PRODUCT; NOT NULL; category
PRODUCT; NOT NULL; base_price
PRODUCT; NOT NULL; is_active
PRODUCT; NOT NULL; created_at
PRODUCT; NOT NULL; updated_at
PRODUCT; LENGTH; sku <= 50
PRODUCT; LENGTH; barcode <= 50
PRODUCT; LENGTH; product_name <= 200
PRODUCT; LENGTH; material <= 100
PRODUCT; DOMAIN; category; Men, Women, Kids
PRODUCT; CHECK; chk_base_price; base_price >= 0
PRODUCT; UNIQUE; product_id
PRODUCT; UNIQUE; sku
PRODUCT; UNIQUE; barcode
PRODUCT_VARIANT; NOT NULL; variant_id
PRODUCT_VARIANT; NOT NULL; product_id
PRODUCT_VARIANT; NOT NULL; size
PRODUCT_VARIANT; NOT NULL; color
PRODUCT_VARIANT; NOT NULL; variant_sku
PRODUCT_VARIANT; NOT NULL; price_adjustment
PRODUCT_VARIANT; NOT NULL; is_active
PRODUCT_VARIANT; NOT NULL; created_at
PRODUCT_VARIANT; LENGTH; size <= 10
PRODUCT_VARIANT; LENGTH; color <= 50
PRODUCT_VARIANT; LENGTH; variant_sku <= 50
PRODUCT_VARIANT; UNIQUE; variant_id
PRODUCT_VARIANT; UNIQUE; variant_sku
PRODUCT_VARIANT; UNIQUE; product_id, size, color
INVENTORY; NOT NULL; inventory_id
INVENTORY; NOT NULL; variant_id
INVENTORY; NOT NULL; store_id
INVENTORY; NOT NULL; quantity_on_hand
INVENTORY; NOT NULL; reserved_quantity
INVENTORY; NOT NULL; available_quantity
INVENTORY; NOT NULL; last_updated
INVENTORY; CHECK; chk_quantity_on_hand; quantity_on_hand >= 0
INVENTORY; CHECK; chk_reserved_quantity; reserved_quantity >= 0
INVENTORY; CHECK; chk_available_quantity; available_quantity >= 0
INVENTORY; UNIQUE; inventory_id
INVENTORY; UNIQUE; variant_id, store_id
STOCK_ADJUSTMENT; NOT NULL; adjustment_id
STOCK_ADJUSTMENT; NOT NULL; inventory_id
STOCK_ADJUSTMENT; NOT NULL; user_id
STOCK_ADJUSTMENT; NOT NULL; adjustment_type
STOCK_ADJUSTMENT; NOT NULL; quantity_change
STOCK_ADJUSTMENT; NOT NULL; created_at
STOCK_ADJUSTMENT; LENGTH; reason <= 255
STOCK_ADJUSTMENT; LENGTH; reference_number <= 50
STOCK_ADJUSTMENT; DOMAIN; adjustment_type; Initial, Addition, Deduction, Transfer
STOCK_ADJUSTMENT; UNIQUE; adjustment_id
STOCK_TRANSFER; NOT NULL; transfer_id
STOCK_TRANSFER; NOT NULL; from_store_id
STOCK_TRANSFER; NOT NULL; to_store_id
STOCK_TRANSFER; NOT NULL; user_id
STOCK_TRANSFER; NOT NULL; status
STOCK_TRANSFER; NOT NULL; transfer_date
STOCK_TRANSFER; DOMAIN; status; Pending, In-Transit, Completed, Cancelled
STOCK_TRANSFER; CHECK; chk_different_stores; from_store_id != to_store_id
STOCK_TRANSFER; UNIQUE; transfer_id
STOCK_TRANSFER_ITEM; NOT NULL; transfer_item_id
STOCK_TRANSFER_ITEM; NOT NULL; transfer_id
STOCK_TRANSFER_ITEM; NOT NULL; variant_id
STOCK_TRANSFER_ITEM; NOT NULL; quantity
STOCK_TRANSFER_ITEM; CHECK; chk_transfer_quantity; quantity > 0
STOCK_TRANSFER_ITEM; UNIQUE; transfer_item_id
PROMOTION; NOT NULL; promotion_id
PROMOTION; NOT NULL; promotion_code
PROMOTION; NOT NULL; promotion_name
PROMOTION; NOT NULL; discount_type
PROMOTION; NOT NULL; discount_value
PROMOTION; NOT NULL; min_purchase_amount
PROMOTION; NOT NULL; start_date
PROMOTION; NOT NULL; end_date
PROMOTION; NOT NULL; is_active
PROMOTION; NOT NULL; created_at
PROMOTION; LENGTH; promotion_code <= 50
PROMOTION; LENGTH; promotion_name <= 100
PROMOTION; DOMAIN; discount_type; Percentage, Fixed Amount
PROMOTION; CHECK; chk_discount_value; discount_value > 0
PROMOTION; CHECK; chk_min_purchase; min_purchase_amount >= 0
PROMOTION; CHECK; chk_date_range; start_date < end_date
PROMOTION; UNIQUE; promotion_id
PROMOTION; UNIQUE; promotion_code
PROMOTION_PRODUCT; NOT NULL; promotion_product_id
PROMOTION_PRODUCT; NOT NULL; promotion_id
PROMOTION_PRODUCT; NOT NULL; product_id
PROMOTION_PRODUCT; NOT NULL; apply_to
PROMOTION_PRODUCT; LENGTH; category_filter <= 50
PROMOTION_PRODUCT; DOMAIN; apply_to; Product, Category
PROMOTION_PRODUCT; UNIQUE; promotion_product_id
PROMOTION_PRODUCT; UNIQUE; promotion_id, product_id
TRANSACTION; NOT NULL; transaction_id
TRANSACTION; NOT NULL; transaction_number
TRANSACTION; NOT NULL; user_id
TRANSACTION; NOT NULL; store_id
TRANSACTION; NOT NULL; transaction_date
TRANSACTION; NOT NULL; subtotal
TRANSACTION; NOT NULL; discount_amount
TRANSACTION; NOT NULL; tax_amount
TRANSACTION; NOT NULL; total_amount
TRANSACTION; NOT NULL; loyalty_points_earned
TRANSACTION; NOT NULL; loyalty_points_used
TRANSACTION; NOT NULL; status
TRANSACTION; NOT NULL; created_at
TRANSACTION; LENGTH; transaction_number <= 50
TRANSACTION; DOMAIN; status; Completed, Cancelled, Returned
TRANSACTION; CHECK; chk_subtotal; subtotal >= 0
TRANSACTION; CHECK; chk_discount; discount_amount >= 0
TRANSACTION; CHECK; chk_tax; tax_amount >= 0
TRANSACTION; CHECK; chk_total; total_amount >= 0
TRANSACTION; CHECK; chk_points_earned; loyalty_points_earned >= 0
TRANSACTION; CHECK; chk_points_used; loyalty_points_used >= 0
TRANSACTION; UNIQUE; transaction_id
TRANSACTION; UNIQUE; transaction_number
TRANSACTION_ITEM; NOT NULL; transaction_item_id
TRANSACTION_ITEM; NOT NULL; transaction_id
TRANSACTION_ITEM; NOT NULL; variant_id
TRANSACTION_ITEM; NOT NULL; quantity
TRANSACTION_ITEM; NOT NULL; unit_price
TRANSACTION_ITEM; NOT NULL; discount_amount
TRANSACTION_ITEM; NOT NULL; line_total
TRANSACTION_ITEM; NOT NULL; created_at
TRANSACTION_ITEM; CHECK; chk_item_quantity; quantity > 0
TRANSACTION_ITEM; CHECK; chk_unit_price; unit_price >= 0
TRANSACTION_ITEM; CHECK; chk_item_discount; discount_amount >= 0
TRANSACTION_ITEM; CHECK; chk_line_total; line_total >= 0
TRANSACTION_ITEM; UNIQUE; transaction_item_id
PAYMENT; NOT NULL; payment_id
PAYMENT; NOT NULL; transaction_id
PAYMENT; NOT NULL; payment_method
PAYMENT; NOT NULL; amount_paid
PAYMENT; NOT NULL; payment_date
PAYMENT; LENGTH; reference_number <= 100
PAYMENT; DOMAIN; payment_method; Cash, Card, QR
PAYMENT; CHECK; chk_amount_paid; amount_paid > 0
PAYMENT; UNIQUE; payment_id
RETURN; NOT NULL; return_id
RETURN; NOT NULL; return_number
RETURN; NOT NULL; transaction_id
RETURN; NOT NULL; user_id
RETURN; NOT NULL; store_id
RETURN; NOT NULL; return_type
RETURN; NOT NULL; refund_amount
RETURN; NOT NULL; status
RETURN; NOT NULL; return_date
RETURN; LENGTH; return_number <= 50
RETURN; DOMAIN; return_type; Return, Exchange
RETURN; DOMAIN; status; Pending, Approved, Rejected, Completed
RETURN; CHECK; chk_refund_amount; refund_amount >= 0
RETURN; UNIQUE; return_id
RETURN; UNIQUE; return_number
RETURN_ITEM; NOT NULL; return_item_id
RETURN_ITEM; NOT NULL; return_id
RETURN_ITEM; NOT NULL; variant_id
RETURN_ITEM; NOT NULL; transaction_item_id
RETURN_ITEM; NOT NULL; quantity
RETURN_ITEM; NOT NULL; refund_amount
RETURN_ITEM; CHECK; chk_return_quantity; quantity > 0
RETURN_ITEM; CHECK; chk_return_refund; refund_amount >= 0
RETURN_ITEM; UNIQUE; return_item_id
LOYALTY_POINT; NOT NULL; point_id
LOYALTY_POINT; NOT NULL; customer_id
LOYALTY_POINT; NOT NULL; points_earned
LOYALTY_POINT; NOT NULL; points_used
LOYALTY_POINT; NOT NULL; points_balance
LOYALTY_POINT; NOT NULL; transaction_type
LOYALTY_POINT; NOT NULL; created_at
LOYALTY_POINT; DOMAIN; transaction_type; Earn, Redeem, Adjustment
LOYALTY_POINT; CHECK; chk_points_earned; points_earned >= 0
LOYALTY_POINT; CHECK; chk_points_used_loyalty; points_used >= 0
LOYALTY_POINT; CHECK; chk_points_balance; points_balance >= 0
LOYALTY_POINT; UNIQUE; point_id
AUDIT_LOG; NOT NULL; log_id
AUDIT_LOG; NOT NULL; user_id
AUDIT_LOG; NOT NULL; action_type
AUDIT_LOG; NOT NULL; entity_type
AUDIT_LOG; NOT NULL; entity_id
AUDIT_LOG; NOT NULL; created_at
AUDIT_LOG; LENGTH; entity_type <= 50
AUDIT_LOG; LENGTH; ip_address <= 45
AUDIT_LOG; DOMAIN; action_type; Create, Update, Delete, Price Change, Stock Adjustment
AUDIT_LOG; UNIQUE; log_id
PRODUCT_VARIANT; FOREIGN KEY; product_id -> PRODUCT.product_id
INVENTORY; FOREIGN KEY; variant_id -> PRODUCT_VARIANT.variant_id
INVENTORY; FOREIGN KEY; store_id -> STORE.store_id
STOCK_ADJUSTMENT; FOREIGN KEY; inventory_id -> INVENTORY.inventory_id
STOCK_ADJUSTMENT; FOREIGN KEY; user_id -> USER.user_id
STOCK_TRANSFER; FOREIGN KEY; from_store_id -> STORE.store_id
STOCK_TRANSFER; FOREIGN KEY; to_store_id -> STORE.store_id
STOCK_TRANSFER; FOREIGN KEY; user_id -> USER.user_id
STOCK_TRANSFER_ITEM; FOREIGN KEY; transfer_id -> STOCK_TRANSFER.transfer_id
STOCK_TRANSFER_ITEM; FOREIGN KEY; variant_id -> PRODUCT_VARIANT.variant_id
PROMOTION_PRODUCT; FOREIGN KEY; promotion_id -> PROMOTION.promotion_id
PROMOTION_PRODUCT; FOREIGN KEY; product_id -> PRODUCT.product_id
TRANSACTION; FOREIGN KEY; customer_id -> CUSTOMER.customer_id
TRANSACTION; FOREIGN KEY; user_id -> USER.user_id
TRANSACTION; FOREIGN KEY; store_id -> STORE.store_id
TRANSACTION; FOREIGN KEY; promotion_id -> PROMOTION.promotion_id
TRANSACTION_ITEM; FOREIGN KEY; transaction_id -> TRANSACTION.transaction_id
TRANSACTION_ITEM; FOREIGN KEY; variant_id -> PRODUCT_VARIANT.variant_id
PAYMENT; FOREIGN KEY; transaction_id -> TRANSACTION.transaction_id
RETURN; FOREIGN KEY; transaction_id -> TRANSACTION.transaction_id
RETURN; FOREIGN KEY; customer_id -> CUSTOMER.customer_id
RETURN; FOREIGN KEY; user_id -> USER.user_id
RETURN; FOREIGN KEY; store_id -> STORE.store_id
RETURN_ITEM; FOREIGN KEY; return_id -> RETURN.return_id
RETURN_ITEM; FOREIGN KEY; variant_id -> PRODUCT_VARIANT.variant_id
RETURN_ITEM; FOREIGN KEY; transaction_item_id -> TRANSACTION_ITEM.transaction_item_id
LOYALTY_POINT; FOREIGN KEY; customer_id -> CUSTOMER.customer_id
LOYALTY_POINT; FOREIGN KEY; transaction_id -> TRANSACTION.transaction_id
AUDIT_LOG; FOREIGN KEY; user_id -> USER.user_id
"""


def audit_sql(sources: dict[str, tuple[str, list[str]]]) -> str:
    """SQL for DuckDB: violations of each rule, NULL where the stand-in lacks a column."""
    columns = {t: {c.rsplit(" AS ", 1)[1] for c in cells} for t, (_, cells) in sources.items()}
    parts = []
    for line in RULES.strip().split("\n"):
        table, kind, rule, *rest = line.split("; ")
        needs, test = {rule}, ""
        source = f'"R_{table}"'
        if kind == "NOT NULL":
            test = f"{rule} IS NULL"
        elif kind == "LENGTH":
            column, most = rule.split(" <= ")
            needs, test = {column}, f"length({column}) > {most}"
        elif kind == "DOMAIN":
            texts = ", ".join(f"'{t}'" for t in rest[0].split(", "))
            test = f"{rule} NOT IN ({texts})"
        elif kind == "CHECK":
            needs = {w for w in rest[0].split() if w[0].isalpha()}
            test = f"NOT ({rest[0]})"
        elif kind == "FOREIGN KEY":
            column, target = rule.split(" -> ")
            parent, key = target.split(".")
            needs = {column}
            test = f'{column} IS NOT NULL AND {column} NOT IN (SELECT {key} FROM "R_{parent}")'
        else:
            needs = set(rule.split(", "))
            present = " AND ".join(f"{c} IS NOT NULL" for c in needs)
        if not needs <= columns[table]:
            found = "SELECT CAST(NULL AS BIGINT)"
        elif kind == "UNIQUE":
            found = (
                f"SELECT count(*) - (SELECT count(*) FROM (SELECT DISTINCT {rule} FROM {source} "
                f"WHERE {present})) FROM {source} WHERE {present}"
            )
        else:
            found = f"SELECT count(*) FROM {source} WHERE {test}"
        parts.append(
            f"SELECT '{table}' AS table_name, '{rule}' AS rule, '{kind}' AS kind, ({found}) AS violations"
        )
    return "\nUNION ALL\n".join(parts)
