"""DuckDB restatement of the models, as named subqueries for the comparison queries."""

from __future__ import annotations

from tallysheet.config import VOUCHER_TYPES
from tallysheet.queries.fixtures import EXCLUDED, SOURCE_SQL


# Fraction digits that decimals are shown with.
FRACTION = 12


def digits(expression: str, name: str | None = None) -> str:
    """A decimal as text with all its digits."""
    return f"cast(cast({expression} as decimal(38,{FRACTION})) as varchar) as {name or expression}"


def quoted(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


# Fixed values in these texts (types, codes, labels) are the business rules, stated a second time.
MODELS: dict[str, str] = {
    "raw_sales": f"""
select h.tipocomprobante as tipo_comprobante, h.numerocomprobante as numero_comprobante,
  h.nropuntodeventa as nro_punto_venta, h.db, h.tipo_consumo,
  cast(concat(cast(h.fechacomprobante as varchar), ' ', h.hora) as timestamp) as fecha_comprobante,
  h.codigocliente as codigo_cliente, h.razonsocial as razon_social_cliente,
  h.descuentoporcentaje as descuento_comprobante,
  b.codigoarticulo as codigo_articulo, b.codigoparticular as codigo_particular_articulo,
  b.descripcion as descripcion_articulo, b.cantidad as cantidad_articulo,
  b.preciounitario as precio_unitario_articulo, b.preciototal as precio_total_articulo,
  b.costoventa as costo_venta_articulo, b.descuento as descuento_articulo,
  b.codigodeposito as codigo_deposito_articulo
from src_header h
join src_body b using (db, tipocomprobante, numerocomprobante)
where h.anulada = 0 and h.tipocomprobante in ({quoted(VOUCHER_TYPES)})
  and b.codigoarticulo not in ({quoted(EXCLUDED)})""",
    "raw_prices": """
select distinct s.codigoarticulo, s.precio as precioactual, c.fechamodificacion, c.precio
from src_changes c
join src_supplied s on c.codigoarticuloproveedor = s.codigo
join src_catalogue a on s.codigoarticulo = a.codigoarticulo
where a.activo = 1""",
    "raw_rubros": """
select r.codigorubro as codigo_rubro, r.codigosuperrubro as codigo_super_rubro,
  coalesce(u.descripcion, 'SIN SUPERRUBRO') as descripcion_super_rubro,
  coalesce(u.unidades, 0) as unidades_super_rubro
from src_rubros r left join src_units u using (codigosuperrubro)""",
    "raw_marcas_lineas": """
select p.id as codigo_marca_int, b.marca_id, b.marca, l.linea_id, l.linea
from src_bridge p left join src_brands b on b.marca_id = p.marca_id
  left join src_lines l on l.linea_id = p.linea_id""",
    "stg_sales": """
select tipo_comprobante, cast(numero_comprobante as bigint) as numero_comprobante,
  cast(nro_punto_venta as int) as nro_punto_venta, db as fuente, tipo_consumo, fecha_comprobante,
  codigo_cliente, razon_social_cliente,
  cast(descuento_comprobante as decimal(22,8)) as descuento_comprobante,
  codigo_articulo, codigo_particular_articulo, descripcion_articulo,
  cast(cantidad_articulo as decimal(22,8)) as cantidad_articulo,
  cast(precio_unitario_articulo as decimal(22,8)) as precio_unitario_articulo,
  cast(precio_total_articulo as decimal(22,8)) as precio_total_articulo,
  cast(costo_venta_articulo as decimal(22,8)) as costo_venta_articulo,
  cast(descuento_articulo as decimal(22,8)) as descuento_articulo,
  codigo_deposito_articulo
from raw_sales""",
    "stg_clients": """
select codigocliente as codigo_cliente, codigoparticular as codigo_particular,
  cuenta_principal_codigo, razonsocial as razon_social, vendedor as codigo_vendedor,
  zona as codigo_zona, barrio, gm as es_gm, ag as es_ag, es_excel, es_agro, es_plan_gomeria,
  contrareembolso <> 0 as contrareembolso, contradeposito <> 0 as contradeposito
from src_clients""",
    "stg_sellers": """
select codigovendedor as codigo_vendedor, trim(razonsocialvend) as nombre_vendedor
from src_sellers where activo = 1""",
    "stg_articulos": """
select codigo_articulo, codigo_particular, trim(descripcion) as descripcion, codigo_rubro,
  codigo_marca, trim(descripcion_marca) as descripcion_marca
from src_articles""",
    "stg_marcas": """
select codigo_marca_int as codigo_marca, marca_id, trim(marca) as marca, linea_id,
  trim(linea) as linea
from raw_marcas_lineas""",
    "stg_prices": """
select codigoarticulo as codigo_articulo,
  cast(precioactual as decimal(22,8)) as precio_actual_proveedor,
  fechamodificacion as fecha_modificacion, cast(precio as decimal(22,8)) as precio_cambio
from raw_prices""",
    "accounts": """
select v.*, c.cuenta_principal_codigo,
  coalesce(c.cuenta_principal_codigo, '') <> '' as es_cuenta_secundaria,
  case when coalesce(c.cuenta_principal_codigo, '') = '' then v.codigo_cliente
       else c.cuenta_principal_codigo end as codigo_cuenta_resuelta
from stg_sales v left join stg_clients c using (codigo_cliente)""",
    "discounts": r"""
select *, nullif(regexp_extract(barrio, '^\s*\(([\d.]+)\)', 1), '') as discount_text
from stg_clients""",
    "gm": """
select v.*, c.razon_social as razon_social_cuenta, c.barrio as barrio_cliente,
  c.codigo_vendedor as codigo_vendedor_cliente, c.codigo_zona as codigo_zona_cliente,
  c.codigo_particular as codigo_particular_cliente, c.es_gm as cliente_es_gm, s.nombre_vendedor,
  try_cast(c.discount_text as decimal(20,10)) as gm_descuento_pct,
  v.tipo_comprobante = 'RE' and v.nro_punto_venta in (17, 18, 19, 109)
    and c.discount_text is not null as es_venta_gm
from accounts v join discounts c on c.codigo_cliente = v.codigo_cuenta_resuelta
  left join stg_sellers s on s.codigo_vendedor = c.codigo_vendedor""",
    "enriched": """
select v.*, coalesce(a.codigo_particular, v.codigo_particular_articulo) as codigo_particular_articulo_master,
  coalesce(a.descripcion, v.descripcion_articulo) as descripcion_articulo_master,
  r.codigo_super_rubro, r.descripcion_super_rubro,
  coalesce(r.unidades_super_rubro, 0) as unidades_min_rubro,
  a.codigo_marca as codigo_marca_int, m.marca_id, m.marca, m.linea_id, m.linea,
  r.codigo_super_rubro is not null
    and coalesce(try_cast(r.codigo_super_rubro as int) not in (-1, 377), true) as es_articulo_valido
from gm v left join stg_articulos a using (codigo_articulo)
  left join raw_rubros r on r.codigo_rubro = a.codigo_rubro
  left join stg_marcas m on m.codigo_marca = try_cast(a.codigo_marca as int)""",
    "instants": """
select codigo_articulo, fecha_modificacion, min(precio_cambio) as precio_cambio
from stg_prices group by all""",
    "current_prices": """
select codigo_articulo, precio_actual_proveedor from stg_prices
qualify row_number() over (partition by codigo_articulo
  order by fecha_modificacion desc nulls first, precio_actual_proveedor) = 1""",
    "firsts": """
select fuente, numero_comprobante, tipo_comprobante, codigo_articulo,
  min(fecha_comprobante) as first_sale
from gm group by all""",
    "matched": """
select f.*, i.precio_cambio, i.fecha_modificacion
from firsts f asof left join instants i
  on i.codigo_articulo = f.codigo_articulo and i.fecha_modificacion >= f.first_sale""",
    "prices": """
select v.*, coalesce(m.precio_cambio, p.precio_actual_proveedor) as precio_proveedor_vigente,
  m.fecha_modificacion as precio_vigente_desde,
  coalesce(m.precio_cambio, p.precio_actual_proveedor) is not null as tiene_precio_historico
from enriched v
  left join matched m using (fuente, numero_comprobante, tipo_comprobante, codigo_articulo)
  left join current_prices p using (codigo_articulo)""",
    "rated": """
select *, es_venta_gm and not es_cuenta_secundaria and gm_descuento_pct is not null as is_rated,
  cast(precio_proveedor_vigente as decimal(19,8)) * cast(cantidad_articulo as decimal(17,8)) as list_value
from prices""",
    "calculated": """
select *,
  case when is_rated and list_value is not null
       then cast(list_value * cast((100 - gm_descuento_pct) * 0.01 as decimal(16,12)) as decimal(38,12))
       when es_cuenta_secundaria then 0 else precio_total_articulo end as precio_final,
  case when is_rated then cast(list_value * cast(gm_descuento_pct * 0.01 as decimal(16,12)) as decimal(38,12)) else 0 end
    as gm_descuento_monto,
  case when is_rated and list_value is not null then 'GM_DESCONTADO'
       when es_cuenta_secundaria then 'SECUNDARIA_CERO' else 'PRECIO_ESTANDAR' end as metodo_precio
from rated""",
    # The branch of a point of sale, in some cases of one deposit only.
    "branches": """
select * from (values
  (1, null, 'BA'), (19, null, 'BA'), (8888, '001', 'BA'),
  (7, null, 'MDP'), (18, null, 'MDP'), (2222, '003', 'MDP'),
  (6, null, 'PICO'), (17, null, 'PICO'), (2222, '001', 'PICO'),
  (8, null, 'ROSARIO'), (109, null, 'ROSARIO'), (8888, '002', 'ROSARIO')
) as t(point_of_sale, deposit, branch)""",
    "breakdown": """
select calculated.*,
  coalesce(b.branch, 'UNKNOWN') as sucursal,
  if(es_venta_gm, cantidad_articulo, 0) as gm_cantidad,
  if(es_venta_gm, precio_final, 0) as gm_monto,
  if(not es_venta_gm and tipo_consumo = 'DS', cantidad_articulo, 0) as ds_cantidad,
  if(not es_venta_gm and tipo_consumo = 'DS', precio_final, 0) as ds_monto,
  if(not es_venta_gm and tipo_consumo = 'PPAL', cantidad_articulo, 0) as ppal_cantidad,
  if(not es_venta_gm and tipo_consumo = 'PPAL', precio_final, 0) as ppal_monto
from calculated left join branches b on b.point_of_sale = nro_punto_venta
  and (b.deposit is null or b.deposit = codigo_deposito_articulo)""",
    "fact": f"""
select tipo_comprobante as voucher_type, numero_comprobante as voucher_number, fuente as source,
  nro_punto_venta as point_of_sale, codigo_deposito_articulo as deposit_code, sucursal as branch,
  tipo_consumo as consumption_type, fecha_comprobante as invoice_datetime,
  strftime(fecha_comprobante, '%Y-%m') as year_month, codigo_cliente as client_code,
  codigo_cuenta_resuelta as account_code, razon_social_cuenta as account_name,
  codigo_particular_cliente as client_particular_code, codigo_vendedor_cliente as vendor_code,
  nombre_vendedor as vendor_name, codigo_zona_cliente as zone_code,
  es_cuenta_secundaria as is_secondary_account, codigo_articulo as article_code,
  codigo_particular_articulo_master as article_particular_code,
  descripcion_articulo_master as article_description, codigo_super_rubro as rubro_code,
  descripcion_super_rubro as rubro_description,
  cast(unidades_min_rubro as double) as min_units_rubro, codigo_marca_int as brand_code,
  marca_id as brand_id, marca as brand_name, linea_id as line_id, linea as line_name,
  {digits('cantidad_articulo', 'quantity')}, {digits('precio_total_articulo', 'sale_price')},
  {digits('costo_venta_articulo', 'provider_price')}, {digits('precio_proveedor_vigente', 'provider_price_at_sale')},
  {digits('precio_final', 'final_price')}, es_venta_gm as is_gm_sale, {digits('gm_descuento_pct', 'gm_discount_pct')},
  {digits('gm_descuento_monto', 'gm_discount_amount')}, {digits('gm_cantidad', 'gm_quantity')}, {digits('gm_monto', 'gm_amount')},
  {digits('ds_cantidad', 'ds_quantity')}, {digits('ds_monto', 'ds_amount')},
  {digits('ppal_cantidad', 'ppal_quantity')}, {digits('ppal_monto', 'ppal_amount')},
  es_articulo_valido as is_valid_article,
  case metodo_precio when 'GM_DESCONTADO' then 'GM_DISCOUNTED'
    when 'SECUNDARIA_CERO' then 'SECONDARY_ZEROED' else 'STANDARD_PRICE' end as price_method
from breakdown""",
}


def oracle(select: str, changed: dict[str, str] | None = None) -> str:
    """The final select with every source table and model available as a subquery; ``changed`` states some of
    them otherwise."""
    ctes = ",\n".join(f"{name} as ({text})" for name, text in (SOURCE_SQL | MODELS | (changed or {})).items())
    own = select.lstrip()
    return f"with {ctes},\n{own[5:]}" if own.startswith("with ") else f"with {ctes}\n{own}"
