"""Declared rules of the 18-table retail system, for the audits."""

from __future__ import annotations

from pyspark.sql import types as T

from depotstar.layouts import read_layout
from depotstar.operators.constraints import ForeignKey, TableRules

# ---------------------------------------------------------------------------------------------
# Table layouts. The first column is the primary key.
LAYOUTS = {
    "USER": "user_id INT NOT NULL, username VARCHAR(50) NOT NULL, "
    "password_hash VARCHAR(255) NOT NULL, full_name VARCHAR(100) NOT NULL, "
    "email VARCHAR(100) NOT NULL, phone VARCHAR(20), role STRING NOT NULL, "
    "is_active BOOLEAN NOT NULL, created_at TIMESTAMP NOT NULL, updated_at TIMESTAMP NOT NULL",
    "CUSTOMER": "customer_id INT NOT NULL, phone_number VARCHAR(20) NOT NULL, "
    "full_name VARCHAR(100) NOT NULL, email VARCHAR(100), membership_tier STRING NOT NULL, "
    "total_points INT NOT NULL, registered_at TIMESTAMP NOT NULL, updated_at TIMESTAMP NOT NULL",
    "STORE": "store_id INT NOT NULL, store_code VARCHAR(20) NOT NULL, "
    "store_name VARCHAR(100) NOT NULL, address VARCHAR(255) NOT NULL, city VARCHAR(50) NOT NULL, "
    "phone VARCHAR(20), is_active BOOLEAN NOT NULL, created_at TIMESTAMP NOT NULL",
    "PRODUCT": "product_id INT NOT NULL, sku VARCHAR(50) NOT NULL, barcode VARCHAR(50) NOT NULL, "
    "product_name VARCHAR(200) NOT NULL, description STRING, material VARCHAR(100), "
    "category STRING NOT NULL, base_price DECIMAL(10,2) NOT NULL, is_active BOOLEAN NOT NULL, "
    "created_at TIMESTAMP NOT NULL, updated_at TIMESTAMP NOT NULL",
    "PRODUCT_VARIANT": "variant_id INT NOT NULL, product_id INT NOT NULL, "
    "size VARCHAR(10) NOT NULL, color VARCHAR(50) NOT NULL, variant_sku VARCHAR(50) NOT NULL, "
    "price_adjustment DECIMAL(10,2) NOT NULL, is_active BOOLEAN NOT NULL, "
    "created_at TIMESTAMP NOT NULL",
    "INVENTORY": "inventory_id INT NOT NULL, variant_id INT NOT NULL, store_id INT NOT NULL, "
    "quantity_on_hand INT NOT NULL, reserved_quantity INT NOT NULL, "
    "available_quantity INT NOT NULL, last_updated TIMESTAMP NOT NULL",
    "STOCK_ADJUSTMENT": "adjustment_id INT NOT NULL, inventory_id INT NOT NULL, "
    "user_id INT NOT NULL, adjustment_type STRING NOT NULL, quantity_change INT NOT NULL, "
    "reason VARCHAR(255), reference_number VARCHAR(50), created_at TIMESTAMP NOT NULL",
    "STOCK_TRANSFER": "transfer_id INT NOT NULL, from_store_id INT NOT NULL, "
    "to_store_id INT NOT NULL, user_id INT NOT NULL, status STRING NOT NULL, "
    "transfer_date TIMESTAMP NOT NULL, completed_at TIMESTAMP, notes STRING",
    "STOCK_TRANSFER_ITEM": "transfer_item_id INT NOT NULL, transfer_id INT NOT NULL, "
    "variant_id INT NOT NULL, quantity INT NOT NULL",
    "PROMOTION": "promotion_id INT NOT NULL, promotion_code VARCHAR(50) NOT NULL, "
    "promotion_name VARCHAR(100) NOT NULL, description STRING, discount_type STRING NOT NULL, "
    "discount_value DECIMAL(10,2) NOT NULL, min_purchase_amount DECIMAL(10,2) NOT NULL, "
    "start_date TIMESTAMP NOT NULL, end_date TIMESTAMP NOT NULL, is_active BOOLEAN NOT NULL, "
    "created_at TIMESTAMP NOT NULL",
    "PROMOTION_PRODUCT": "promotion_product_id INT NOT NULL, promotion_id INT NOT NULL, "
    "product_id INT NOT NULL, apply_to STRING NOT NULL, category_filter VARCHAR(50)",
    "TRANSACTION": "transaction_id INT NOT NULL, transaction_number VARCHAR(50) NOT NULL, "
    "customer_id INT, user_id INT NOT NULL, store_id INT NOT NULL, promotion_id INT, "
    "transaction_date TIMESTAMP NOT NULL, subtotal DECIMAL(10,2) NOT NULL, "
    "discount_amount DECIMAL(10,2) NOT NULL, tax_amount DECIMAL(10,2) NOT NULL, "
    "total_amount DECIMAL(10,2) NOT NULL, loyalty_points_earned INT NOT NULL, "
    "loyalty_points_used INT NOT NULL, status STRING NOT NULL, created_at TIMESTAMP NOT NULL",
    "TRANSACTION_ITEM": "transaction_item_id INT NOT NULL, transaction_id INT NOT NULL, "
    "variant_id INT NOT NULL, quantity INT NOT NULL, unit_price DECIMAL(10,2) NOT NULL, "
    "discount_amount DECIMAL(10,2) NOT NULL, line_total DECIMAL(10,2) NOT NULL, "
    "created_at TIMESTAMP NOT NULL",
    "PAYMENT": "payment_id INT NOT NULL, transaction_id INT NOT NULL, "
    "payment_method STRING NOT NULL, amount_paid DECIMAL(10,2) NOT NULL, "
    "reference_number VARCHAR(100), payment_date TIMESTAMP NOT NULL",
    "RETURN": "return_id INT NOT NULL, return_number VARCHAR(50) NOT NULL, "
    "transaction_id INT NOT NULL, customer_id INT, user_id INT NOT NULL, store_id INT NOT NULL, "
    "return_type STRING NOT NULL, refund_amount DECIMAL(10,2) NOT NULL, reason STRING, "
    "status STRING NOT NULL, return_date TIMESTAMP NOT NULL, processed_at TIMESTAMP",
    "RETURN_ITEM": "return_item_id INT NOT NULL, return_id INT NOT NULL, variant_id INT NOT NULL, "
    "transaction_item_id INT NOT NULL, quantity INT NOT NULL, "
    "refund_amount DECIMAL(10,2) NOT NULL",
    "LOYALTY_POINT": "point_id INT NOT NULL, customer_id INT NOT NULL, transaction_id INT, "
    "points_earned INT NOT NULL, points_used INT NOT NULL, points_balance INT NOT NULL, "
    "transaction_type STRING NOT NULL, created_at TIMESTAMP NOT NULL",
    "AUDIT_LOG": "log_id INT NOT NULL, user_id INT NOT NULL, action_type STRING NOT NULL, "
    "entity_type VARCHAR(50) NOT NULL, entity_id INT NOT NULL, old_value STRING, "
    "new_value STRING, ip_address VARCHAR(45), created_at TIMESTAMP NOT NULL",
}
# Permitted texts.
DOMAINS = {
    "USER": {"role": ["Admin", "Sales"]},
    "CUSTOMER": {"membership_tier": ["Silver", "Gold", "Diamond"]},
    "PRODUCT": {"category": ["Men", "Women", "Kids"]},
    "STOCK_ADJUSTMENT": {"adjustment_type": ["Initial", "Addition", "Deduction", "Transfer"]},
    "STOCK_TRANSFER": {"status": ["Pending", "In-Transit", "Completed", "Cancelled"]},
    "PROMOTION": {"discount_type": ["Percentage", "Fixed Amount"]},
    "PROMOTION_PRODUCT": {"apply_to": ["Product", "Category"]},
    "TRANSACTION": {"status": ["Completed", "Cancelled", "Returned"]},
    "PAYMENT": {"payment_method": ["Cash", "Card", "QR"]},
    "RETURN": {
        "return_type": ["Return", "Exchange"],
        "status": ["Pending", "Approved", "Rejected", "Completed"],
    },
    "LOYALTY_POINT": {"transaction_type": ["Earn", "Redeem", "Adjustment"]},
    "AUDIT_LOG": {
        "action_type": ["Create", "Update", "Delete", "Price Change", "Stock Adjustment"]
    },
}
# Conditions by table and rule name.
CHECKS = {
    "CUSTOMER": {"chk_total_points": "total_points >= 0"},
    "PRODUCT": {"chk_base_price": "base_price >= 0"},
    "INVENTORY": {
        "chk_quantity_on_hand": "quantity_on_hand >= 0",
        "chk_reserved_quantity": "reserved_quantity >= 0",
        "chk_available_quantity": "available_quantity >= 0",
    },
    "STOCK_TRANSFER": {"chk_different_stores": "from_store_id != to_store_id"},
    "STOCK_TRANSFER_ITEM": {"chk_transfer_quantity": "quantity > 0"},
    "PROMOTION": {
        "chk_discount_value": "discount_value > 0",
        "chk_min_purchase": "min_purchase_amount >= 0",
        "chk_date_range": "start_date < end_date",
    },
    "TRANSACTION": {
        "chk_subtotal": "subtotal >= 0",
        "chk_discount": "discount_amount >= 0",
        "chk_tax": "tax_amount >= 0",
        "chk_total": "total_amount >= 0",
        "chk_points_earned": "loyalty_points_earned >= 0",
        "chk_points_used": "loyalty_points_used >= 0",
    },
    "TRANSACTION_ITEM": {
        "chk_item_quantity": "quantity > 0",
        "chk_unit_price": "unit_price >= 0",
        "chk_item_discount": "discount_amount >= 0",
        "chk_line_total": "line_total >= 0",
    },
    "PAYMENT": {"chk_amount_paid": "amount_paid > 0"},
    "RETURN": {"chk_refund_amount": "refund_amount >= 0"},
    "RETURN_ITEM": {
        "chk_return_quantity": "quantity > 0",
        "chk_return_refund": "refund_amount >= 0",
    },
    "LOYALTY_POINT": {
        "chk_points_earned": "points_earned >= 0",
        "chk_points_used_loyalty": "points_used >= 0",
        "chk_points_balance": "points_balance >= 0",
    },
}
# Unique keys besides the primary keys.
UNIQUE = {
    "USER": [["username"], ["email"]],
    "CUSTOMER": [["phone_number"]],
    "STORE": [["store_code"]],
    "PRODUCT": [["sku"], ["barcode"]],
    "PRODUCT_VARIANT": [["variant_sku"], ["product_id", "size", "color"]],
    "INVENTORY": [["variant_id", "store_id"]],
    "PROMOTION": [["promotion_code"]],
    "PROMOTION_PRODUCT": [["promotion_id", "product_id"]],
    "TRANSACTION": [["transaction_number"]],
    "RETURN": [["return_number"]],
}
# Foreign keys and what a delete of the parent does.
FOREIGN_KEYS = [
    ForeignKey("PRODUCT_VARIANT", "product_id", "PRODUCT", "product_id", "RESTRICT"),
    ForeignKey("INVENTORY", "variant_id", "PRODUCT_VARIANT", "variant_id", "RESTRICT"),
    ForeignKey("INVENTORY", "store_id", "STORE", "store_id", "RESTRICT"),
    ForeignKey("STOCK_ADJUSTMENT", "inventory_id", "INVENTORY", "inventory_id", "RESTRICT"),
    ForeignKey("STOCK_ADJUSTMENT", "user_id", "USER", "user_id", "RESTRICT"),
    ForeignKey("STOCK_TRANSFER", "from_store_id", "STORE", "store_id", "RESTRICT"),
    ForeignKey("STOCK_TRANSFER", "to_store_id", "STORE", "store_id", "RESTRICT"),
    ForeignKey("STOCK_TRANSFER", "user_id", "USER", "user_id", "RESTRICT"),
    ForeignKey("STOCK_TRANSFER_ITEM", "transfer_id", "STOCK_TRANSFER", "transfer_id", "CASCADE"),
    ForeignKey("STOCK_TRANSFER_ITEM", "variant_id", "PRODUCT_VARIANT", "variant_id", "RESTRICT"),
    ForeignKey("PROMOTION_PRODUCT", "promotion_id", "PROMOTION", "promotion_id", "CASCADE"),
    ForeignKey("PROMOTION_PRODUCT", "product_id", "PRODUCT", "product_id", "CASCADE"),
    ForeignKey("TRANSACTION", "customer_id", "CUSTOMER", "customer_id", "SET NULL"),
    ForeignKey("TRANSACTION", "user_id", "USER", "user_id", "RESTRICT"),
    ForeignKey("TRANSACTION", "store_id", "STORE", "store_id", "RESTRICT"),
    ForeignKey("TRANSACTION", "promotion_id", "PROMOTION", "promotion_id", "SET NULL"),
    ForeignKey("TRANSACTION_ITEM", "transaction_id", "TRANSACTION", "transaction_id", "CASCADE"),
    ForeignKey("TRANSACTION_ITEM", "variant_id", "PRODUCT_VARIANT", "variant_id", "RESTRICT"),
    ForeignKey("PAYMENT", "transaction_id", "TRANSACTION", "transaction_id", "CASCADE"),
    ForeignKey("RETURN", "transaction_id", "TRANSACTION", "transaction_id", "RESTRICT"),
    ForeignKey("RETURN", "customer_id", "CUSTOMER", "customer_id", "SET NULL"),
    ForeignKey("RETURN", "user_id", "USER", "user_id", "RESTRICT"),
    ForeignKey("RETURN", "store_id", "STORE", "store_id", "RESTRICT"),
    ForeignKey("RETURN_ITEM", "return_id", "RETURN", "return_id", "CASCADE"),
    ForeignKey("RETURN_ITEM", "variant_id", "PRODUCT_VARIANT", "variant_id", "RESTRICT"),
    ForeignKey("RETURN_ITEM", "transaction_item_id", "TRANSACTION_ITEM", "transaction_item_id", "RESTRICT"),
    ForeignKey("LOYALTY_POINT", "customer_id", "CUSTOMER", "customer_id", "CASCADE"),
    ForeignKey("LOYALTY_POINT", "transaction_id", "TRANSACTION", "transaction_id", "SET NULL"),
    ForeignKey("AUDIT_LOG", "user_id", "USER", "user_id", "RESTRICT"),
]
# Column defaults; NOW stands for the load time.
NOW = "now"
DEFAULTS = {
    "USER": {"created_at": NOW, "updated_at": NOW, "is_active": True, "role": "Sales"},
    "CUSTOMER": {"total_points": 0, "updated_at": NOW, "registered_at": NOW, "membership_tier": "Silver"},
    "STORE": {"created_at": NOW, "is_active": True},
    "PRODUCT": {"created_at": NOW, "updated_at": NOW, "is_active": True},
    "PRODUCT_VARIANT": {"price_adjustment": 0, "created_at": NOW, "is_active": True},
    "INVENTORY": {"quantity_on_hand": 0, "reserved_quantity": 0, "available_quantity": 0, "last_updated": NOW},
    "STOCK_ADJUSTMENT": {"created_at": NOW},
    "STOCK_TRANSFER": {"transfer_date": NOW, "status": "Pending"},
    "PROMOTION": {"min_purchase_amount": 0, "created_at": NOW, "is_active": True},
    "PROMOTION_PRODUCT": {"apply_to": "Product"},
    "TRANSACTION": {"discount_amount": 0, "tax_amount": 0, "loyalty_points_earned": 0, "loyalty_points_used": 0, "created_at": NOW, "transaction_date": NOW, "status": "Completed"},
    "TRANSACTION_ITEM": {"discount_amount": 0, "created_at": NOW},
    "PAYMENT": {"payment_date": NOW},
    "RETURN": {"return_date": NOW, "refund_amount": 0, "status": "Pending"},
    "LOYALTY_POINT": {"points_earned": 0, "points_used": 0, "created_at": NOW},
    "AUDIT_LOG": {"created_at": NOW},
}
# ---------------------------------------------------------------------------------------------


def _fields(table: str) -> list[T.StructField]:
    return read_layout(LAYOUTS[table]).fields


def layout(table: str) -> T.StructType:
    """The table's columns with Spark types; lengths are audited, not enforced."""
    return T.StructType(
        [
            T.StructField(
                f.name, T.StringType() if isinstance(f.dataType, T.VarcharType) else f.dataType
            )
            for f in _fields(table)
        ]
    )


def primary_keys() -> dict[str, str]:
    return {t: _fields(t)[0].name for t in LAYOUTS}


def rules() -> dict[str, TableRules]:
    """The row and uniqueness rules of every table."""
    return {
        t: TableRules(
            not_null=[f.name for f in _fields(t) if not f.nullable],
            lengths={
                f.name: f.dataType.length
                for f in _fields(t)
                if isinstance(f.dataType, T.VarcharType)
            },
            domains=DOMAINS.get(t, {}),
            checks=CHECKS.get(t, {}),
            unique=[[_fields(t)[0].name], *UNIQUE.get(t, [])],
        )
        for t in LAYOUTS
    }


def foreign_keys() -> list[ForeignKey]:
    return list(FOREIGN_KEYS)


def defaults(table: str, now) -> dict:
    """Values for the columns a batch does not carry; `now` is the load time as a Column."""
    return {c: now if v is NOW else v for c, v in DEFAULTS.get(table, {}).items()}
